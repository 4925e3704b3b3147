"""The structure of HTML as a column: one batched pass over a payload gives its elements and texts in document order, and
selections are expressions over these arrays, so nothing is shuffled or read twice.

Each element knows its parent, how many elements begin before its end, and which texts lie in it; "inside", "parent",
"nearest ancestor" and "text of" are slices and comparisons of these numbers. Elements that are never closed end with
the element around them; end tags without a beginning say nothing; comments, scripts, styles and templates have no text.
A payload that cannot be read, and a null one, is null."""

from __future__ import annotations

from collections.abc import Callable
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta source track wbr basefont bgsound command frame image isindex keygen menuitem nextid param spacer".split())
SILENT = ("script", "style", "template")
#: Attributes that are kept.
ATTRIBUTES = frozenset(("class", "id", "href", "datetime", "date"))

_NODE = pa.struct([("tag", pa.string()), ("at", pa.int32()), ("parent", pa.int32()), ("end", pa.int32()), ("low", pa.int32()), ("high", pa.int32()), ("attributes", pa.map_(pa.string(), pa.string()))])
_OUTLINE = pa.struct([("nodes", pa.list_(_NODE)), ("texts", pa.list_(pa.string()))])


class _Outline(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes: list[dict] = []
        self.texts: list[str] = []
        self.open: list[dict] = []
        self.held: list[str] = []

    def flush(self) -> None:
        text = "".join(self.held).strip()
        self.held = []
        if text and not any(n["tag"] in SILENT for n in self.open):
            self.texts.append(text)

    def handle_data(self, data):
        self.held.append(data)

    def handle_comment(self, data):
        self.flush()

    def handle_decl(self, decl):
        self.flush()

    def handle_pi(self, data):
        self.flush()

    def unknown_decl(self, data):
        self.flush()
        if data.upper().startswith("CDATA["):
            self.held.append(data[6:])
            self.flush()

    def begin(self, tag, attrs):
        self.flush()
        kept = {k: v or "" for k, v in attrs if k in ATTRIBUTES}
        node = {"tag": tag, "at": len(self.nodes), "parent": self.open[-1]["at"] if self.open else -1, "low": len(self.texts), "attributes": list(kept.items())}
        self.nodes.append(node)
        self.open.append(node)

    def end(self) -> None:
        node = self.open.pop()
        node["end"], node["high"] = len(self.nodes), len(self.texts)

    def handle_starttag(self, tag, attrs):
        self.begin(tag, attrs)
        if tag in VOID:
            self.end()

    def handle_startendtag(self, tag, attrs):
        self.begin(tag, attrs)
        self.end()

    def handle_endtag(self, tag):
        self.flush()
        if any(n["tag"] == tag for n in self.open):
            while self.open[-1]["tag"] != tag:
                self.end()
            self.end()


def read(payload: str | None) -> dict | None:
    """The elements and texts of one payload."""
    if payload is None:
        return None
    parser = _Outline()
    try:
        parser.feed(payload)
        parser.close()
    except (AssertionError, ValueError):  # what the reader refuses
        return None
    parser.flush()
    while parser.open:
        parser.end()
    return {"nodes": parser.nodes, "texts": parser.texts}


_NUMBERS = ("at", "parent", "end", "low", "high")
_NODE_TYPE = T.StructType([T.StructField("tag", T.StringType()), *(T.StructField(c, T.IntegerType()) for c in _NUMBERS), T.StructField("attributes", T.MapType(T.StringType(), T.StringType()))])


@F.arrow_udf(T.StructType([T.StructField("nodes", T.ArrayType(_NODE_TYPE)), T.StructField("texts", T.ArrayType(T.StringType()))]))
def outline(payload: pa.Array) -> pa.Array:
    return pa.array([read(x) for x in payload.to_pylist()], _OUTLINE)


def attribute(node: Column, name: str) -> Column:
    return F.try_element_at(node["attributes"], F.lit(name))


def named(*tags: str, has: str | None = None) -> Callable[[Column], Column]:
    """Elements of these names (any for none), with an attribute."""

    def test(node: Column) -> Column:
        by_tag = node["tag"].isin(*tags) if tags else F.lit(True)
        return by_tag & attribute(node, has).isNotNull() if has else by_tag

    return test


def classed(name: str, *tags: str) -> Callable[[Column], Column]:
    """Elements with a class among theirs."""
    return lambda node: named(*tags)(node) & F.coalesce(F.array_contains(F.split(attribute(node, "class"), r"\s+"), name), F.lit(False))


def every(doc: Column, test: Callable[[Column], Column], inside: Column | None = None) -> Column:
    """The elements that pass, in document order; of those inside an element, if one is given."""
    nodes = doc["nodes"] if inside is None else F.slice(doc["nodes"], inside["at"] + 2, F.greatest(inside["end"] - inside["at"] - 1, F.lit(0)))
    return F.filter(nodes, test)


def first(doc: Column, test: Callable[[Column], Column], inside: Column | None = None) -> Column:
    """The first such element, or null."""
    return F.get(every(doc, test, inside), 0)


def parent(doc: Column, node: Column) -> Column:
    """The element right around one; null at the top."""
    return F.when(node["parent"] >= 0, F.get(doc["nodes"], node["parent"]))


def above(doc: Column, node: Column, test: Callable[[Column], Column]) -> Column:
    """The nearest element around one that passes, or null."""
    around = F.filter(F.slice(doc["nodes"], F.lit(1), node["at"]), lambda n: (n["end"] > node["at"]) & test(n))
    return F.try_element_at(around, F.lit(-1))


def text_of(doc: Column, node: Column | None = None) -> Column:
    """The texts in an element, joined by blanks; of the whole payload for none."""
    if node is None:
        return F.array_join(doc["texts"], " ")
    return F.array_join(F.slice(doc["texts"], node["low"] + 1, node["high"] - node["low"]), " ")
