"""Fixed vocabulary of the regulatory domain: data that operators take as arguments."""

from __future__ import annotations

# Word lists and tables that results depend on.

CATEGORY_TERMS: dict[str, tuple[str, ...]] = {
    "Fiscal": (
        "impuesto", "contribuyente", "codigo fiscal", "renta", "iva", "isr", "ieps", "sat", "prodecon", "credito fiscal",
        "ejecucion fiscal", "procedimiento administrativo de ejecucion", "comprobante fiscal", "cfdi", "tax", "taxation",
        "transfer pricing",
    ),
    "Aduanero": (
        "aduana", "aduanero", "agencia nacional de aduanas", "reglas generales de comercio exterior", "pedimento",
        "recinto fiscal", "importador", "exportador", "customs", "customs duties",
    ),
    "Comercio exterior": (
        "comercio exterior", "importacion", "exportacion", "arancel", "tarifa de la ley de los impuestos generales", "ligie",
        "tigie", "cuota compensatoria", "antidumping", "tratado de libre comercio", "cupo", "regla de origen", "immex",
        "prosec", "tariff", "tariffs", "trade agreement", "usmca", "free trade", "trade remedy", "antidumping duty",
        "section 301", "export control", "sanction", "sanctions", "wto",
    ),
    "Propiedad intelectual": (
        "propiedad intelectual", "propiedad industrial", "impi", "patente", "marca", "derecho de autor", "pirateria",
        "signos distintivos", "modelo de utilidad", "secreto industrial", "indicacion geografica", "denominacion de origen",
        "patent", "trademark", "copyright", "intellectual property", "geographical indication",
    ),
    "Normalización": (
        "norma oficial mexicana", "proy-nom", "nom-", "normalizacion", "infraestructura de la calidad",
        "evaluacion de la conformidad",
    ),
    "Iniciativa": ("iniciativa", "proyecto de decreto", "reforma", "adiciona", "deroga", "dictamen", "minuta"),
    "Penal": (
        "delito", "penal", "fiscalia", "fgr", "defraudacion fiscal", "contrabando", "extincion de dominio",
        "prision preventiva", "codigo nacional de procedimientos penales", "orden de aprehension", "war crimes",
        "crimes against humanity", "prosecutor", "arrest warrant", "genocide", "genocidio", "lesa humanidad",
        "crimenes de guerra", "rome statute", "estatuto de roma",
    ),
    "Anti-lavado": (
        "lavado de dinero", "lfpiorpi", "actividades vulnerables", "uif", "unidad de inteligencia financiera", "gafi",
        "fatf", "beneficiario controlador", "operaciones inusuales", "money laundering", "aml", "terrorist financing",
    ),
    "Comercio internacional": (
        "t-mec", "usmca", "omc", "wto", "ocde", "oecd", "arbitraje de inversion", "investment arbitration", "icsid", "ciadi",
        "tratado bilateral de inversion", "panel binacional", "dispute settlement", "world bank", "banco mundial", "imf",
        "fmi", "aranceles reciprocos", "global tariff",
    ),
    "Litigio internacional": (
        "declaration of intervention", "application instituting proceedings", "institutes proceedings", "provisional measures",
        "advisory opinion", "preliminary objections", "delivers its judgment", "arbitral award", "arbitral tribunal",
    ),
}

ALWAYS_RELEVANT_AUTHORITIES = ("secretaria de hacienda", "shcp", "hacienda y credito publico", "secretaria de economia")

ADMINISTRATIVE_LAW = (
    "ley federal de procedimiento administrativo", "lfpa", "ley organica de la administracion publica federal", "loapf",
    "reglamento interior", "estatuto organico", "manual de organizacion", "estructura organica",
    "administracion publica federal", "servicio profesional de carrera", "delegan facultades", "delegacion de facultades",
    "facultades delegadas", "acuerdo delegatorio", "adscripcion de unidades administrativas", "unidades administrativas",
    "organos administrativos desconcentrados", "sectorizacion", "desincorporacion", "extincion de organismo",
    "creacion de organismo",
)

APPOINTMENT_ACTIONS = (
    "nombramiento", "nombramientos", "nombra", "nombro", "nombrado", "nombrada", "designacion", "designa", "designo",
    "designado", "designada", "designados", "designadas", "ratificacion", "ratifica", "remocion", "renuncia", "suplencia",
    "encargado de despacho", "encargada de despacho", "toma de protesta",
)

FEDERAL_POSITIONS = (
    "secretario de estado", "secretaria de estado", "subsecretario", "subsecretaria", "titular de la secretaria",
    "titular del organo", "titular de la unidad", "titular de la jefatura", "titular de jefatura", "titular del instituto",
    "titular del organismo", "director general", "directora general", "director de area", "directora de area",
    "subdirector", "subdirectora", "jefe de unidad", "jefa de unidad", "jefe de departamento", "jefa de departamento",
    "coordinador general", "coordinadora general", "oficial mayor", "comisionado", "comisionada",
    "presidente del organismo", "presidenta del organismo", "secretario tecnico", "secretaria tecnica", "vocal ejecutivo",
    "vocal ejecutiva", "embajador", "embajadora", "consul general",
)

EXPLICIT_APPOINTMENTS = ("nombramientos presidenciales", "nuevo titular", "nueva titular", "nuevo director general", "nueva directora general")

CONTENTIOUS_EXPLICIT = (
    "ley federal de procedimiento contencioso administrativo", "lfpca", "juicio contencioso administrativo",
    "juicio de nulidad", "demanda de nulidad", "nulidad lisa y llana", "nulidad para efectos", "recurso de reclamacion",
    "incidente de suspension", "medida cautelar",
)

CONTENTIOUS_PROCESS = (
    "sentencia definitiva", "cumplimiento de sentencia", "nulidad de la resolucion", "plazos procesales",
    "terminos y plazos procesales", "actividades jurisdiccionales", "procedimiento jurisdiccional", "medio de defensa",
)

ADMINISTRATIVE_COURTS = ("tribunal federal de justicia administrativa", "tfja", "sala regional", "sala superior", "sala especializada")

FISCAL_CONTENTIOUS = (
    "juicio de resolucion exclusiva de fondo", "juicio contencioso administrativo federal en materia fiscal",
    "sala especializada en materia fiscal", "nulidad de credito fiscal", "impugnacion de credito fiscal",
)

HIGH_VALUE = (
    "codigo fiscal", "ley aduanera", "reglas generales de comercio exterior", "ley del impuesto",
    "tarifa de la ley de los impuestos generales", "propiedad industrial", "cuota compensatoria",
    "ley federal de procedimiento administrativo", "ley organica de la administracion publica federal",
    "ley federal de procedimiento contencioso administrativo", "nombramiento", "designacion", "iniciativa",
    "proyecto de decreto", "usmca", "tariff", "trade agreement", "indicacion geografica", "denominacion de origen",
)

BONUS_SOURCES = ("DOF", "ANAM", "TFJA", "OMC", "Secretariado T-MEC", "Senado", "Diputados", "CIADI", "Banco Mundial", "CPI", "CIJ")

#: (canonical name, branch, short name, aliases), in order of precedence.
ORGANS: tuple[tuple[str, str, str, tuple[str, ...]], ...] = (
    ("Secretaría de Hacienda y Crédito Público", "Ejecutivo federal", "SHCP", ("secretaria de hacienda", "shcp", "hacienda y credito publico")),
    ("Servicio de Administración Tributaria", "Ejecutivo federal", "SAT", ("servicio de administracion tributaria", "sat")),
    ("Agencia Nacional de Aduanas de México", "Ejecutivo federal", "ANAM", ("agencia nacional de aduanas", "anam")),
    ("Secretaría de Economía", "Ejecutivo federal", "SE", ("secretaria de economia", "snice", "comision de comercio exterior")),
    ("Secretaría de Relaciones Exteriores", "Ejecutivo federal", "SRE", ("secretaria de relaciones exteriores", "sre")),
    ("Secretaría de Gobernación", "Ejecutivo federal", "SEGOB", ("secretaria de gobernacion", "segob")),
    ("Instituto Mexicano de la Propiedad Industrial", "Organismo descentralizado", "IMPI", ("instituto mexicano de la propiedad industrial", "impi")),
    ("Instituto Nacional del Derecho de Autor", "Órgano administrativo desconcentrado", "INDAUTOR", ("instituto nacional del derecho de autor", "indautor")),
    ("Procuraduría Federal del Consumidor", "Organismo descentralizado", "PROFECO", ("procuraduria federal del consumidor", "profeco")),
    ("Comisión Nacional para la Protección y Defensa de los Usuarios de Servicios Financieros", "Organismo descentralizado", "CONDUSEF", ("comision nacional para la proteccion y defensa de los usuarios", "condusef")),
    ("Comisión Nacional Bancaria y de Valores", "Órgano administrativo desconcentrado", "CNBV", ("comision nacional bancaria y de valores", "cnbv")),
    ("Comisión Federal de Competencia Económica", "Organismo autónomo", "COFECE", ("comision federal de competencia economica", "cofece")),
    ("Instituto Nacional de Transparencia, Acceso a la Información y Protección de Datos", "Organismo autónomo", "INAI", ("instituto nacional de transparencia", "inai")),
    ("Tribunal Federal de Justicia Administrativa", "Órgano jurisdiccional", "TFJA", ("tribunal federal de justicia administrativa", "tfja")),
    ("Suprema Corte de Justicia de la Nación", "Poder Judicial", "SCJN", ("suprema corte", "scjn")),
    ("Cámara de Diputados", "Legislativo federal", "Diputados", ("camara de diputados", "gaceta parlamentaria")),
    ("Senado de la República", "Legislativo federal", "Senado", ("senado de la republica", "camara de senadores")),
    ("Procuraduría de la Defensa del Contribuyente", "Organismo descentralizado", "PRODECON", ("procuraduria de la defensa del contribuyente", "prodecon")),
    ("Banco de México", "Organismo autónomo", "Banxico", ("banco de mexico", "banxico")),
    ("Instituto Mexicano del Seguro Social", "Organismo descentralizado", "IMSS", ("instituto mexicano del seguro social", "imss")),
    ("Instituto de Seguridad y Servicios Sociales de los Trabajadores del Estado", "Organismo descentralizado", "ISSSTE", ("instituto de seguridad y servicios sociales de los trabajadores del estado", "issste")),
    ("Instituto Nacional de los Pueblos Indígenas", "Organismo descentralizado", "INPI", ("instituto nacional de los pueblos indigenas", "inpi")),
    ("Fiscalía General de la República", "Organismo autónomo", "FGR", ("fiscalia general de la republica", "fgr")),
    ("Secretaría de Marina", "Ejecutivo federal", "Semar", ("secretaria de marina", "semar")),
    ("Presidencia de la República", "Ejecutivo federal", "Presidencia", ("presidencia de la republica", "poder ejecutivo", "oficina de la presidencia")),
    ("Organización de las Naciones Unidas", "Organismo internacional", "ONU", ("naciones unidas", "onu", "un news")),
    ("Oficina del Representante Comercial de EEUU", "Gobierno de EEUU", "USTR", ("ustr", "united states trade representative")),
    ("Departamento de Comercio de EEUU", "Gobierno de EEUU", "ITA", ("trade.gov", "department of commerce", "international trade administration")),
    ("Centro Internacional de Arreglo de Diferencias relativas a Inversiones", "Organismo internacional", "CIADI", ("ciadi", "centro internacional de arreglo de diferencias", "icsid")),
    ("Banco Mundial", "Organismo internacional", "Banco Mundial", ("banco mundial", "world bank")),
    ("Fondo Monetario Internacional", "Organismo internacional", "FMI", ("fondo monetario internacional", "fmi", "imf")),
    ("Organización Mundial del Comercio", "Organismo internacional", "OMC", ("organizacion mundial del comercio", "omc", "wto")),
    ("Organización para la Cooperación y el Desarrollo Económicos", "Organismo internacional", "OCDE", ("organizacion para la cooperacion", "ocde", "oecd")),
    ("Corte Penal Internacional", "Organismo internacional", "CPI", ("corte penal internacional", "international criminal court")),
    ("Corte Internacional de Justicia", "Organismo internacional", "CIJ", ("corte internacional de justicia", "international court of justice")),
    ("Secretariado del T-MEC", "Organismo internacional", "T-MEC", ("secretariado del t-mec", "secretariado t-mec")),
)

#: Jurisdiction and country or organisation by source.
ORIGINS: dict[str, tuple[str, str]] = {
    "ONU Noticias": ("internacional", "ONU"),
    "USTR": ("internacional", "EEUU"),
    "Trade.gov": ("internacional", "EEUU"),
    "CIADI": ("internacional", "CIADI"),
    "Banco Mundial": ("internacional", "Banco Mundial"),
    "CPI": ("internacional", "CPI"),
    "CIJ": ("internacional", "CIJ"),
    "OMC": ("internacional", "OMC"),
    "Secretariado T-MEC": ("internacional", "T-MEC"),
}
DEFAULT_ORIGIN = ("nacional", "México")

DEFAULT_PRIMARY: dict[str, str] = {
    "CIADI": "Comercio internacional",
    "Banco Mundial": "Comercio internacional",
    "OMC": "Comercio internacional",
    "CIJ": "Comercio internacional",
    "CPI": "Penal",
    "Secretariado T-MEC": "Comercio internacional",
}

DOCUMENT_TYPE_TAGS: tuple[tuple[str, str], ...] = (
    ("decreto", "Decreto"), ("acuerdo", "Acuerdo"), ("resolucion", "Resolución"), ("aviso", "Aviso"),
    ("convocatoria", "Convocatoria"), ("iniciativa", "Iniciativa"), ("sentencia", "Sentencia"), ("oficio", "Oficio"),
    ("norma", "Norma"), ("reglamento", "Reglamento"), ("nombramiento", "Nombramiento"), ("circular", "Circular"),
)

DECENTRALISED_MARKERS = ("descentralizado", "desconcentrado", "autonomo")

# The ink of a card by the first word of its subject, and without one.
INKS = (("comercio internacional", "#3f6e9f"), ("comercio exterior", "#4f7f7c"), ("fiscal", "#b18443"), ("penal", "#a45b62"), ("lavado", "#756a8b"), ("legislativo", "#5577a2"), ("descentralizada", "#9b6971"), ("centralizada", "#73866f"))
PLAIN_INK = "#54789b"

MONTHS = ("enero", "febrero", "marzo", "abril", "mayo", "junio", "julio", "agosto", "septiembre", "octubre", "noviembre", "diciembre")

#: Sentences that lengthen a short summary, in turn.
FILLERS = (
    "Consulta la fuente oficial para el alcance, vigencia y efectos jurídicos aplicables.",
    "Revisa el texto íntegro para confirmar obligaciones, plazos, autoridades responsables y excepciones.",
    "Verifica en la publicación original los requisitos, procedimientos y su entrada en vigor.",
)
REASON_DEFAULT = "Actualización oficial seleccionada por su importancia jurídica y relevancia para el seguimiento regulatorio del día"
REASON_FILLER = "Revisa la fuente primaria para confirmar su alcance jurídico aplicable"

STATUS_LABELS = {
    "pending": "Pendiente (en trámite, según la base oficial)",
    "concluded": "Concluido (según la base oficial)",
    "active": "Activo (según la base oficial)",
    "completed": "Concluido (según la base oficial)",
}

CARD_SECTIONS = ("## Qué se publicó", "## Sustancia", "## Fuente")
DETAIL_SECTIONS = ("## Qué se publicó", "## Sustancia", "## Fuente oficial")

ACT_NUMBER = r"(?i)(?:oficio|acuerdo|circular|resoluci[oó]n|expediente|no\.|núm)\s*[:.]?\s*[A-Z0-9][A-Z0-9/.-]*\d|\b\d{3,}[-/][A-Z0-9/.-]*\d"
OFFICE_TITLE = r"(?i)^(oficio|acuerdo|circular|resoluci[oó]n|expediente)\s+[A-Z0-9/.-]*\d"
#: Legislative formulas that titles do not begin with: how they are told, and what is cut.
FORMULA_BEGINNING = "^(proyecto de decreto|iniciativa con proyecto|punto de acuerdo)"
FORMULA = r"(?iU)^(proyecto de decreto|iniciativa con proyecto(?: de decreto)?|punto de acuerdo)\s+(?:por el que|que)?\s*"

#: Sentences of extractive summaries.
SUBSTANCE_NOTE = "Resumen extractivo pendiente de revisión editorial; consulta la fuente oficial para el alcance completo."
SUMMARY_NOTE = "Consulta la fuente íntegra para confirmar su alcance, fechas de vigencia, obligaciones, requisitos, excepciones, autoridades responsables, procedimientos y efectos jurídicos aplicables."
NO_AUTHORITY = "autoridad federal"
NO_TOPICS = "materias reguladas por el radar"
NO_SUBSTANCE = "Sin sustancia editorial disponible."
NO_CATEGORY = "Sin materia clasificada"
NO_BODY = "Autoridad no identificada"
NO_TYPE = "Documento oficial"

#: Words that may not end a document type.
TYPE_CONNECTORS = ("de", "del", "por", "el", "la", "los", "que", "con", "mediante", "se", "cual")

#: Labels of arbitration cases.
CASE_STATUS = {"Pending": "Pendiente", "Concluded": "Concluido"}
NO_PARTY = "Parte no identificada"
NO_STATUS = "Estatus no informado"
