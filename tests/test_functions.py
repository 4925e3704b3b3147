import datetime as dt
import unicodedata
from urllib.parse import quote

from pyspark.sql import functions as F

from tamiz.functions import dates, text
from tamiz.plans import vocabulary as V


def values(spark, rows, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(rows)], "i int, x string")
    return [r.y for r in df.select("i", column(F.col("x")).alias("y")).orderBy("i").collect()]


def test_clean_and_words(spark):
    rows = [None, "", "  a\t b c ", "x &amp; y", "<p>one <b>two</b></p><script>no</script> three", "a < b"]
    assert values(spark, rows, text.clean) == ["", "", "a b c", "x & y", "one two three", "a < b"]
    assert values(spark, ["", " ", "a  b"], lambda c: F.size(text.words(c))) == [0, 0, 2]


def test_fold(spark):
    rows = ["Ñandú ÉÈ Straße", "ﬁn ª…", "Łódź ā š ő", "caf\u0065\u0301", "№ ½ Ⅳ", "ΆΣ ё й", "日本 ﾊﾞ", "İ", ""]
    want = ["".join(c for c in unicodedata.normalize("NFKD", x.lower()) if not unicodedata.combining(c)) for x in rows]
    assert values(spark, rows, lambda c: text.fold(c)) == want


def test_bounded_summary_lengths(spark):
    rows = [" ".join(f"w{i}" for i in range(n)) for n in range(100)]
    got = values(spark, rows, text.bounded_summary)

    def want(n):
        w = [f"w{i}" for i in range(n)]
        k = 0
        while len(w) < 40:
            w += V.FILLERS[k % 3].split()
            k += 1
        return " ".join(w[:80]).rstrip(" .,;:") + "."

    assert got == [want(n) for n in range(100)]


def test_titles_reasons_and_links(spark):
    assert values(spark, ["", " - uno dos.", "a b c d e f g h i j k l m n"], text.concise_title) == ["Actualización regulatoria", "Uno dos", "A b c d e f g h i j k l"]
    assert [len(x.split()) for x in values(spark, ["", "uno", " ".join("x" * 50)], text.bounded_reason)] == [15, 11, 32]
    ids = ["dof:1 a+*~/é"]
    assert values(spark, ids, text.detail_url) == ["ficha.html?id=" + quote(ids[0], safe="")]
    assert values(spark, ["Oficio 500-05-2026", "", "123"], text.base_act_type) == ["Oficio", "Publicación oficial", "Publicación oficial"]
    assert values(spark, ["## A\nuno\n\n## B\ndos"], lambda c: text.section(c, "## A")) == ["uno"]


def test_a_title_begins_with_one_capital_as_in_sql(spark):
    import duckdb

    rows = ["ßein x", "ŉa", "ﬁn", "ǆ", "ᾳ", "ΐ", "ñu", "ƛ", "𐐨a", "éa", "1a", "Ⅷ", "ⅷ"]
    want = [duckdb.execute("SELECT upper(left($1, 1)) || substr($1, 2)", [x]).fetchone()[0] for x in rows]
    assert values(spark, rows, text.concise_title) == want and want[0] == "ẞein x"


def test_parse_date(spark):
    rows = ["7/3/2026", "07.03.2026", "2026-03-07", "2026-03-07 10:11:12", "lunes 7 de marzo de 2026, x", "31/02/2026", "no"]
    day = dt.date(2026, 3, 7)
    assert values(spark, rows, dates.parse_date) == [day] * 5 + [None, None]


def test_edition_date(spark):
    rows = ["2026-07-08T03:30:00+00:00", "2026-07-08T03:30:00Z", "2026-07-08T03:30:00", "2026-07-08T06:30:00Z"]
    assert [str(x) for x in values(spark, rows, dates.edition_date)] == ["2026-07-07", "2026-07-07", "2026-07-08", "2026-07-08"]
