"""Scans: every column a nullable string, textual nulls turned into null, a row id for order.

Schemas are named, never inferred. Compressed text is one task per file; `spread` deals the rows out
again after the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from pyspark.sql import types as T

from taxograph import vocab as V
from taxograph.functions import scalars as S

MAPPING_COLUMNS = ("WdID", *V.ID_COLUMNS, "WdName")
LINEAGE_LONG_COLUMNS = ("WdID", "WdName", "hTax", "hTaxName", "hTaxRank")
LINEAGE_COLUMNS = ("WdID", "WdName", *V.RANKS)
TAXON_COLUMNS = tuple(f"{side}Taxon{part}" for side in ("source", "target") for part in ("Id", "Name", "PathNames", "PathRankNames"))
RECORD_COLUMNS = (
    "interactionTypeName", "interactionTypeId", "localityName", "referenceDoi", "sourceDOI", "decimalLatitude", "decimalLongitude",
    *(f"{side}{part}" for side in ("source", "target") for part in ("BodyPartName", "BodyPartId", "LifeStageName", "LifeStageId", "SexName")),
)
TRAIT_COLUMNS = ("AccSpeciesName", "AccSpeciesID", "ObservationID", "ObsDataID", "Dataset", "DatasetID", "Reference", "TraitName", "TraitID", "DataName", "DataID", "OrigValueStr", "OrigUnitStr", "UnitName")


def require_columns(df: DataFrame, columns: tuple[str, ...], what: str = "table") -> DataFrame:
    """df, if it has the columns; the error names the missing ones."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{what} lacks the columns {', '.join(missing)}")
    return df


def header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    """The first line of a text file, which may be compressed; a small driver-side read."""
    first = spark.read.option("encoding", encoding).text(path).limit(1).first()
    return (first[0] if first else "").lstrip("﻿")


def delimited(
    spark: SparkSession,
    path: str,
    sep: str = ",",
    columns: tuple[str, ...] | None = None,
    encoding: str = "UTF-8",
    quoting: bool = True,
    keep_na: bool = False,
    row_id: bool = True,
    spread: int = 0,
    multiline: bool = False,
) -> DataFrame:
    """A delimited text file with a header, plain or compressed.

    columns: those to keep, checked by name. keep_na: leave textual nulls as they are. row_id adds the
    number of the row, from 0 without gaps over all files in the order of their names. spread: number of partitions to deal the rows out to. multiline: quoted values may
    hold line ends; each file is then one task.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", encoding).option("inferSchema", False)
    reader = reader.option("quote", '"' if quoting else "").option("escape", '"' if quoting else "").option("multiLine", multiline)
    df = reader.csv(path)
    if row_id:
        df, numbers = _with_places(df)
    places = [c for c in PLACES if row_id]
    df = df.toDF(*[c if c in places else S.clean_column_name(c) for c in df.columns])
    if columns:
        df = require_columns(df, columns, path).select(*columns, *places)
    if not keep_na:
        df = df.select(*[F.col(c) if c in places else S.na(F.col(f"`{c}`")).alias(c) for c in df.columns])
    if row_id:
        df = df.join(numbers, ["__file", "__block"]).withColumn("row_id", F.col("__at") + F.col("__shift")).drop(*PLACES, "__shift")
    return df.repartition(spread) if spread else df


PLACES = ("__file", "__block", "__at")


def _with_places(scan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A scan of files with each row's place, and what turns places into row numbers.

    A task reads a range of a file front to back, so that the rows of a range have consecutive ids; ranges
    are ordered by file and start. Numbers do not depend on how files are cut or dealt to tasks. One task
    adds up a row a range.
    """
    placed = scan.select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    ranges = placed.groupBy("__file", "__block").agg(F.count(F.lit(1)).alias("n"), F.min("__at").alias("low"))
    before = F.sum("n").over(W.orderBy("__file", "__block")) - F.col("n")
    return placed, ranges.select("__file", "__block", (before - F.col("low")).alias("__shift"))


def mapping_table(spark: SparkSession, path: str) -> DataFrame:
    """Entity, its fifteen external identifiers and its name."""
    return delimited(spark, path, columns=MAPPING_COLUMNS)


def lineage_long(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, columns=LINEAGE_LONG_COLUMNS)


def lineage_aligned(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, columns=LINEAGE_COLUMNS)


def interactions(spark: SparkSession, path: str, taxa_only: bool = False, encoding: str = "UTF-8", spread: int = 0) -> DataFrame:
    """Interaction records, tab-separated and unquoted; one reader for matching and graph building."""
    return delimited(spark, path, "\t", TAXON_COLUMNS if taxa_only else (*TAXON_COLUMNS, *RECORD_COLUMNS), encoding, quoting=False, spread=spread)


def traits(spark: SparkSession, path: str, spread: int = 0) -> DataFrame:
    return delimited(spark, path, "\t", TRAIT_COLUMNS, "ISO-8859-1", quoting=False, spread=spread)


def species_list(spark: SparkSession, path: str) -> DataFrame:
    return delimited(spark, path, ",", ("TRY_SpeciesName", "TRY_AccSpeciesName"), "ISO-8859-1")


def dictionary(spark: SparkSession, path: str, key: str, value: str, sep: str = ",", quoting: bool = True, lower_key: bool = False) -> DataFrame:
    """(key, value) of a two-column mapping; of equal keys the last row wins. A missing file or column gives no rows."""
    none = spark.createDataFrame([], "key string, value string")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return none
    df = delimited(spark, path, sep, quoting=quoting, keep_na=True)
    if not {key, value} <= set(df.columns):
        return none
    name = F.lower(F.col(key)) if lower_key else F.col(key)
    rows = df.select(name.alias("key"), F.col(value).alias("value"), "row_id").filter("key is not null")
    return rows.groupBy("key").agg(F.max_by("value", "row_id").alias("value"))


def sex_map(spark: SparkSession, path: str) -> DataFrame:
    return dictionary(spark, path, "input", "output", "\t", quoting=False, lower_key=True)


#: Header names under which a term mapping's three columns are known.
TERM_HEADERS = {"input": ("InputTerm", "Input Term"), "match": ("BestMatch", "Best Match", "Primary Label", "Matched Term"), "uri": ("URI",)}


def term_maps(spark: SparkSession, *paths: str) -> DataFrame:
    """(input, match, uri) of several mapping files, one after the other; row_id orders them all."""
    out = None
    for k, path in enumerate(paths):
        df = delimited(spark, path)
        chosen = {name: next((h for h in heads if h in df.columns), None) for name, heads in TERM_HEADERS.items()}
        if None in chosen.values():
            raise ValueError(f"{path} lacks one of {TERM_HEADERS}")
        rows = df.select(*[F.col(f"`{h}`").alias(n) for n, h in chosen.items()], F.struct(F.lit(k).alias("file"), "row_id").alias("row_id"))
        out = rows if out is None else out.unionByName(rows)
    return out


def term_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line) of a text file, blank lines left out."""
    return spark.read.text(path).select(S.strip(F.col("value")).alias("line")).filter("line <> ''")


def sniffed(spark: SparkSession, path: str, candidates: tuple[str, ...] = ("\t", ",", ";", "|")) -> DataFrame:
    """A delimited file whose separator is the first candidate that gives several columns."""
    first = header(spark, path)
    for sep in candidates:
        if sep in first:
            return delimited(spark, path, sep)
    raise ValueError(f"{path}: none of the separators {candidates!r} splits its header")


def query_result(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """A query result: variable names without ?, every cell cleaned of markup."""
    df = delimited(spark, path, sep, quoting=False, keep_na=True)
    return df.select(*[S.na(S.clean_label(F.col(f"`{c}`"))).alias(c) if c != "row_id" else F.col(c) for c in df.columns])


def turtle_prefixes(spark: SparkSession, path: str) -> DataFrame:
    """(prefix, namespace) declared in a Turtle file."""
    pattern = r"(?i)^\s*@?prefix\s+([\w-]*):\s*<([^>]*)>"
    lines = spark.read.text(path).filter(F.col("value").rlike(pattern))
    return lines.select(F.regexp_extract("value", pattern, 1).alias("prefix"), F.regexp_extract("value", pattern, 2).alias("namespace"))


def ontology_terms(spark: SparkSession, *paths: str) -> DataFrame:
    """(label, uri, main_label) of RDF/XML ontologies: the label and exact, broad and related synonyms of each class."""
    text = lambda tag: T.StructField(tag, T.ArrayType(T.StringType()))
    schema = T.StructType([T.StructField("_rdf:about", T.StringType()), text("rdfs:label"), text("oboInOwl:hasExactSynonym"), text("oboInOwl:hasBroadSynonym"), text("oboInOwl:hasRelatedSynonym")])
    raw = spark.read.format("xml").option("rowTag", "owl:Class").option("valueTag", "_VALUE").schema(schema).load(",".join(paths))
    return expand_synonyms(raw.select(F.col("`_rdf:about`").alias("uri"), F.col("`rdfs:label`").alias("labels"), *[F.col(f"`oboInOwl:has{k}Synonym`").alias(k.lower()) for k in ("Exact", "Broad", "Related")]))


def expand_synonyms(terms: DataFrame) -> DataFrame:
    """(label, uri, main_label): a row for the first label and each synonym of a term that has a label."""
    empty = F.array().cast("array<string>")
    every = F.concat(F.array(F.col("labels")[0]), *[F.coalesce(k, empty) for k in ("exact", "broad", "related")])
    return terms.filter(F.size("labels") > 0).select(F.explode(every).alias("label"), "uri", F.col("labels")[0].alias("main_label"))
