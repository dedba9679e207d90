"""From raw documents to training shards in five stages, each written as Parquet and read again.

Stages take (spark, docs, sf_dir) and work on all that the stage before kept. All but the last
return the columns of documents, further columns of theirs included.

Defined cases, for all stages: decisions are made per id, and a null id stands for a document that no
other row names, so that rows without id are kept by all stages that remove; null and empty texts
are kept; an id given twice is judged by all its rows, and near-dedup leaves one row of it; without
labels, benchmark items or documents nothing is removed; texts are used whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taxograph.llm import common, decontaminate, hilbert_shards, mixing, near_dedup, quality_lm

SHARDS = 16
#: No SQL: the quality model is not expressible; stages are tested against brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """docs but for some ids, which are made once."""
    ids = common.staged(ids.select("doc_id").distinct(), "removed", common.partitions(docs.sparkSession))
    return common.by_ids(docs, ids, "doc_id", "left_anti").select(*docs.columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the language model trained on the documents labelled good rejects."""
    trusted = spark.read.parquet(f"{sf_dir}/labels.parquet").filter("quality = 1").select("doc_id")
    return _without(docs, quality_lm.quality(docs, trusted).filter("not kept and doc_id is not null"))


def keep_first_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near-duplicates, and one row of it."""
    found = common.staged(near_dedup.near_duplicates(docs).select("doc_id", "kept").filter("doc_id is not null"), "found")
    left = _without(docs, found.filter("not kept"))
    again = common.staged(found.filter("kept").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "again", common.partitions(spark))
    if not common.rows_in(again):
        return left
    # the rows of an id have equal values in all columns, or else the first by their values stays
    repeated = common.by_ids(left, again, "doc_id", "left_semi")
    first = repeated.groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row")).select("row.*")
    return common.by_ids(left, again, "doc_id", "left_anti").select(*docs.columns).union(first.select(*docs.columns))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold benchmark passages."""
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return _without(docs, found.filter("contaminated and doc_id is not null"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents as often as the scheduled mix takes them, to the nearest whole number.

    Documents without words stay once, and so do null ids. The order is left to the next stage, which
    sorts all rows anew.
    """
    taken = mixing.mix(docs).groupBy("doc_id").agg(F.sum("taken").alias("taken"), F.sum("size").alias("size"))
    copies = taken.filter("doc_id is not null and size > 0").select("doc_id", F.round(F.col("taken") / F.col("size")).cast("int").alias("__copies")).filter("__copies <> 1")
    counted = common.by_ids(docs, common.staged(copies, "copies", common.partitions(spark)), "doc_id", "left")
    times = F.expr("array_repeat(0, coalesce(__copies, 1))")
    return counted.select(*docs.columns, F.explode(times).alias("__copy")).drop("__copy")


def cut_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and slot in the order of the Hilbert curve."""
    rest = tuple(c for c in docs.columns if c != "doc_id" and c not in hilbert_shards.RESULT)
    return hilbert_shards.hilbert_shards(docs, SHARDS, keep=rest).drop("curve")


STAGES = [
    ("quality classifier", keep_quality),
    ("MinHash near-dedup", keep_first_of_near_copies),
    ("benchmark decontamination", keep_uncontaminated),
    ("mixing sources to target weights", mix_sources),
    ("sharding", cut_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.staged(docs, "stage")
    return docs
