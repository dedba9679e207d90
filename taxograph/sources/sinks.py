"""Sinks: delimited text, Turtle, and the triple table as Parquet by predicate."""

from __future__ import annotations

import logging
import re
from dataclasses import replace
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.functions import scalars as S

LOG = logging.getLogger("taxograph")


def write_delimited(df: DataFrame, path: str, sep: str = ",", gzip: bool = False, mode: str = "overwrite", one_file: bool = False) -> None:
    """Delimited text with a header, white space kept and quotes doubled, as the readers expect them.

    An overwrite is idempotent, so that a run can be repeated.
    """
    out = df.coalesce(1) if one_file else df
    options = {"header": True, "sep": sep, "compression": "gzip" if gzip else "none", "emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    out.write.mode(mode).options(**options).csv(path)
    LOG.info("wrote %s", path)


def write_matches(matches: DataFrame, path: str) -> None:
    """Term matches with the similarity to four places."""
    columns = [F.col("term").alias("Input Term"), F.col("label").alias("Matched Term"), F.col("main_label").alias("Primary Label"), F.col("uri").alias("URI"), F.format_string("%.4f", "score").alias("Similarity Score")]
    write_delimited(matches.select(*columns), path)


LOCAL = r"\A[A-Za-z_][A-Za-z0-9_-]*\z"
#: A local part has no # or /, and all namespaces end in one, so an IRI's last of these ends the only one that fits.
NAMES = {base: name for name, base in V.PREFIXES.items()}


def iri_term(c: Column) -> Column:
    """An IRI as a prefixed name where its local part allows, else in angle brackets."""
    local = F.substring_index(F.substring_index(c, "#", -1), "/", -1)
    name = S.lookup(NAMES, F.substring(c, F.lit(1), F.length(c) - F.length(local)))
    plain = F.concat(F.lit("<"), F.regexp_replace(c, r'[\x00-\x20<>"{}|^`\\]', "_"), F.lit(">"))
    return F.when(name.isNotNull() & local.rlike(LOCAL), F.concat(name, F.lit(":"), local)).otherwise(plain)


def _constant_term(iri: str) -> str:
    """The term of a predicate."""
    local = re.split("[#/]", iri)[-1]
    name = NAMES.get(iri[: len(iri) - len(local)])
    if iri == V.RDF + "type":
        return "a"
    return f"{name}:{local}" if name is not None and re.fullmatch(LOCAL[2:-2], local) else f"<{re.sub(r'[\x00-\x20<>"{}|^`\\]', '_', iri)}>"


def literal_term(value: Column, dtype: Column) -> Column:
    text = value
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(escaped))
    return F.concat(F.lit('"'), text, F.lit('"'), F.when(dtype.isNotNull() & (dtype != V.XSD + "string"), F.concat(F.lit("^^"), iri_term(dtype))).otherwise(F.lit("")))


def turtle_lines(triples: DataFrame) -> DataFrame:
    """(value): one Turtle statement per triple, prefixed names where possible, so that no subject is gathered."""
    subject = F.when(F.col("s").startswith("_:"), F.col("s")).otherwise(iri_term(F.col("s")))
    predicate = F.when(F.col("p") == V.RDF + "type", F.lit("a")).otherwise(iri_term(F.col("p")))
    object_ = F.when(F.col("o_kind") == "literal", literal_term(F.col("o"), F.col("o_dtype"))).when(F.col("o_kind") == "bnode", F.col("o")).otherwise(iri_term(F.col("o")))
    return triples.select(F.concat_ws(" ", subject, predicate, object_, F.lit(".")).alias("value")).distinct()


def spelled(statements: list) -> list:
    """Statements with their ends as Turtle terms, so that a record's ends are spelled once, not in each triple."""
    made: dict = {}

    def once(c: Column, how: str, make) -> Column:
        return made.setdefault((id(c), how), make(c))

    subject = lambda c: F.when(c.startswith("_:"), c).otherwise(iri_term(c))
    out = []
    for x in statements:
        dtype = F.lit(x.dtype).cast("string") if x.dtype is None or isinstance(x.dtype, str) else x.dtype
        o = once(x.o, f"literal {x.dtype}", lambda c: literal_term(c, dtype)) if x.kind == "literal" else x.o if x.kind == "bnode" else once(x.o, "iri", iri_term)  # noqa: B023
        out.append(replace(x, s=once(x.s, "subject", subject), p=_constant_term(x.p), o=o))
    return out


def spelled_lines(graph) -> DataFrame:
    """(value): the Turtle statements of a graph in parts that was made with `spelled`. Equal lines of a record are in one task."""
    line = F.concat_ws(" ", "s", "p", "o", F.lit(".")).alias("value")
    parts = [x.select("row_id", line).distinct().select("value") for x in graph.own] + [graph.shared.select(line).distinct()]
    return reduce(DataFrame.union, parts)


def _prefix_lines() -> list[str]:
    """The prefix block, an empty line last."""
    return [*(f"@prefix {n}: <{b}> ." for n, b in V.PREFIXES.items()), ""]


def write_turtle(triples: DataFrame, path: str, gzip: bool = True) -> None:
    """A folder of Turtle parts: the prefixes first, then statements; the parts concatenate to one document."""
    spark = triples.sparkSession
    head = spark.createDataFrame([("\n".join(_prefix_lines()),)], "value string").coalesce(1)
    option = {"compression": "gzip" if gzip else "none"}
    head.write.mode("overwrite").options(**option).text(f"{path}/0-prefixes")
    turtle_lines(triples).write.mode("overwrite").options(**option).text(f"{path}/1-statements")


def _fs(spark: SparkSession, path: str):
    """The file system of a path, and a maker of its paths."""
    make = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def removed(spark: SparkSession, path: str) -> None:
    """Remove a folder that was staged."""
    fs, make = _fs(spark, path)
    fs.delete(make(path), True)


def write_turtle_document(triples: DataFrame, path: str, gzip: bool = True) -> str:
    """One Turtle document, `path`/document.ttl(.gz): the prefix block once, then the statements; returns its name.

    The parts are written by all tasks. A file system that can join files appends them behind the prefixes as they
    are (gzip members make one gzip file), so no bytes move; elsewhere one task copies the lines. The document
    takes its name last, so that a run that died leaves none; an overwrite can be repeated.
    """
    spark, parts, out = triples.sparkSession, f"{path}/_parts", f"{path}/document.ttl{'.gz' if gzip else ''}"
    fs, make = _fs(spark, path)
    fs.delete(make(path), True)
    write_turtle(triples, parts, gzip)
    if fs.hasPathCapability(make(path), "fs.capability.paths.concat"):
        listed = lambda folder: sorted(f"{folder}/{s.getPath().getName()}" for s in fs.listStatus(make(folder)) if s.getPath().getName().startswith("part-") and s.getLen())
        (head,), more = listed(f"{parts}/0-prefixes"), listed(f"{parts}/1-statements")
        if more:
            joined = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(more))
            for k, name in enumerate(more):
                joined[k] = make(name)
            fs.concat(make(head), joined)
    else:
        head = _prefix_lines()

        def behind_head(batches):
            yield pa.RecordBatch.from_arrays([pa.array(head, pa.string())], ["value"])
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.string())], ["value"])

        # passed on batch by batch: a sort would hold the whole document in its task
        lines = spark.read.text(f"{parts}/1-statements").coalesce(1).mapInArrow(behind_head, "value string")
        lines.write.options(compression="gzip" if gzip else "none").text(f"{parts}/2-document")
        (head,) = (f"{parts}/2-document/{s.getPath().getName()}" for s in fs.listStatus(make(f"{parts}/2-document")) if s.getPath().getName().startswith("part-"))
    if not fs.rename(make(head), make(out)):
        raise OSError(f"{head} could not be named {out}")
    fs.delete(make(parts), True)
    return out


def write_triples(triples: DataFrame, path: str) -> None:
    """The triple table, a folder per predicate, so that a pattern with a predicate reads one folder."""
    # a rebalance by predicate splits what is too large for one task, as a common predicate is
    triples.hint("rebalance", "p").write.mode("overwrite").partitionBy("p").parquet(path)


def read_triples(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("basePath", path).parquet(path)
