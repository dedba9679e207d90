"""Diagrams as XML: documents in, their cells as rows, entities in labels linked, documents out.

A document is a row (name, document). It is cut at the starts of its cells and put together again
inside one expression, so that everything but the changed labels stays byte for byte and nothing is
shuffled. A diagram is drawn by hand, so one fits a row. Compressed diagrams and comments that hold
cells are not looked into.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxograph import vocab as V

#: Fixed value: the markup whose content may be an entity.
WRAPPED = r"(?is)<(font|b|i|div|span)([^>]*)>(.*?)</\1>"

# a cell's start tag up to its label, and the label with its quotes
_CELL = r"""(?=<mxCell[\s/>])"""
_LABEL = r"""\A(<mxCell(?:\s+(?!value[\s=])[^\s=>/]+\s*=\s*(?:"[^"]*"|'[^']*'))*\s+value\s*=\s*)("[^"]*"|'[^']*')"""
_ENDS = r"(?U)\A[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z"


def stripped(c: Column) -> Column:
    return F.regexp_replace(c, _ENDS, "")


def link_wrapped(markup: Column, prefixes: dict[str, str] | None = None) -> Column:
    """Markup in which wrapped text of the form prefix:name is a link, if the prefix is known.

    The text counts without inner tags, the name up to an opening bracket if there is a closing one.
    Inner tags are kept inside the link. Markup that holds links already stays as it is, null stays null.
    """
    known = F.create_map(*[F.lit(x) for item in (prefixes or V.PREFIXES).items() for x in item])

    def linked(hit: Column) -> Column:
        content = F.regexp_extract(hit, WRAPPED, 3)
        text = stripped(F.regexp_replace(content, "<[^>]+>", ""))
        prefix = stripped(F.substring_index(text, ":", 1))
        local = stripped(F.substring(text, F.instr(text, ":") + 1, F.length(text)))
        local = F.when(local.contains("(") & local.contains(")"), stripped(F.substring_index(local, "(", 1))).otherwise(local)
        base = F.when(text.contains(":") & ~text.startswith("http"), F.try_element_at(known, prefix))
        inner = F.concat(F.lit('<a href="'), base, local, F.lit('">'), F.when(content.contains("<"), content).otherwise(text), F.lit("</a>"))
        tag, attributes = F.regexp_extract(hit, WRAPPED, 1), F.regexp_extract(hit, WRAPPED, 2)
        return F.coalesce(F.concat(F.lit("<"), tag, attributes, F.lit(">"), inner, F.lit("</"), tag, F.lit(">")), hit)

    hits = F.transform(F.regexp_extract_all(markup, F.lit(WRAPPED), F.lit(0)), linked)
    between = F.split(markup, WRAPPED, -1)
    joined = F.array_join(F.transform(F.arrays_zip(between.alias("between"), hits.alias("hits")), lambda x: F.concat(x["between"], F.coalesce(x["hits"], F.lit("")))), "")
    return F.when(markup.contains("<a href="), markup).otherwise(joined)


def unescaped(raw: Column) -> Column:
    """The value of an attribute from its text without quotes."""
    parsed = F.xpath_string(F.concat(F.lit('<v v="'), F.replace(raw, F.lit('"'), F.lit("&quot;")), F.lit('"/>')), F.lit("/v/@v"))
    return F.when(raw.rlike(r"[&\n\r\t]"), parsed).otherwise(raw)


def escaped(value: Column) -> Column:
    """The text of an attribute between double quotes."""
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\n", "&#10;"), ("\r", "&#13;"), ("\t", "&#09;")):
        value = F.replace(value, F.lit(plain), F.lit(entity))
    return value


def link_cells(documents: DataFrame, prefixes: dict[str, str] | None = None) -> DataFrame:
    """Documents with the labels of their cells linked; a cell without a change keeps its text."""

    def cell(piece: Column) -> Column:
        head, quoted = F.regexp_extract(piece, _LABEL, 1), F.regexp_extract(piece, _LABEL, 2)
        label = unescaped(F.substring(quoted, 2, F.length(quoted) - 2))
        made = link_wrapped(label, prefixes)
        rest = F.substring(piece, F.length(head) + F.length(quoted) + 1, F.length(piece))
        return F.when((quoted != "") & (made != label), F.concat(head, F.lit('"'), escaped(made), F.lit('"'), rest)).otherwise(piece)

    return documents.withColumn("document", F.array_join(F.transform(F.split("document", _CELL, -1), cell), ""))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(name, document) of a file, of the files in a folder by their names, or of what write_documents wrote."""
    files = spark.read.text(path, wholetext=True)
    if "name" in files.columns:  # with its type given, so that a name of digits stays as it is
        return spark.read.schema("value string, name string").text(path, wholetext=True).select("name", F.col("value").alias("document"))
    return files.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*\z", "").alias("name"), F.col("value").alias("document"))


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    """(id, value, style, parent, source, target) a cell, over all files; an absent attribute is null."""
    names = ["id", "value", "style", "parent", "source", "target"]
    cells = spark.read.format("xml").option("rowTag", "mxCell").option("ignoreSurroundingSpaces", False).schema(", ".join(f"_{n} string" for n in names)).load(path)
    return cells.select(*[F.col(f"_{n}").alias(n) for n in names])


def write_documents(documents: DataFrame, path: str) -> None:
    """A folder per name with its document, a line feed after it; names are distinct and not empty. An overwrite can be repeated."""
    documents.select("name", "document").write.mode("overwrite").partitionBy("name").option("lineSep", "\n").text(path)
