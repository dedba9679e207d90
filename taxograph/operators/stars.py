"""Stars: the triples of a subject as one record, so that a star query is a scan and not joins.

A record is (s, links): a map from predicate to its distinct objects. A group of patterns with one
subject, and OPTIONALs of one pattern on it, become a filter on the map's keys and one explode per
variable. Subjects with more than MOST triples stay triples, so that no record grows without bound;
their part of a query is solved by joins and united with the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MOST = 1000


def write_stars(triples: DataFrame, path: str, most: int = MOST) -> Stars:
    """Group triples (s, p, o) by subject and write them to a folder, with the triples themselves by predicate."""
    spark = triples.sparkSession
    triples.hint("rebalance", "p").write.mode("overwrite").partitionBy("p").parquet(f"{path}/triples")
    rows = spark.read.option("basePath", f"{path}/triples").parquet(f"{path}/triples")
    large = rows.groupBy("s").count().filter(F.col("count") > most).select("s")
    large.write.mode("overwrite").parquet(f"{path}/large")
    large = spark.read.parquet(f"{path}/large")
    links = F.collect_set(F.struct("p", "o"))
    of = lambda p: F.transform(F.filter("links", lambda x: x["p"] == p), lambda x: x["o"])
    predicates = F.array_distinct(F.transform("links", lambda x: x["p"]))
    small = rows.join(large, "s", "left_anti") if large.head(1) else rows
    small = small.select("s", "p", "o").groupBy("s").agg(links.alias("links"))
    small.select("s", F.map_from_entries(F.transform(predicates, lambda p: F.struct(p, of(p)))).alias("links")).write.mode("overwrite").parquet(f"{path}/stars")
    return Stars(spark, path)


@dataclass
class Stars:
    """A written star table and its triples."""

    spark: SparkSession
    path: str

    @property
    def triples(self) -> DataFrame:
        return self.spark.read.option("basePath", f"{self.path}/triples").parquet(f"{self.path}/triples")

    @property
    def large(self) -> DataFrame | None:
        """The triples of subjects that have no record; None if there are none."""
        large = self.spark.read.parquet(f"{self.path}/large")
        return self.triples.join(large, "s", "left_semi") if large.head(1) else None

    def star(self, subject: str, required: list[tuple[str, str]], optional: list[tuple[str, str]]) -> DataFrame:
        """Solutions over the records: (predicate, variable or constant) of each pattern; variables are all different."""
        out = self.spark.read.parquet(f"{self.path}/stars").withColumnRenamed("s", subject)
        for p, o in required:
            out = out.filter(F.map_contains_key("links", F.lit(p)) if o.startswith("?") else F.array_contains(F.col("links")[p], F.lit(o)))
        columns = [subject]
        for p, o, inner in [(*x, True) for x in required if x[1].startswith("?")] + [(*x, False) for x in optional]:
            values = (F.explode if inner else F.explode_outer)(F.col("links")[p]).alias(o[1:])
            out = out.select(*columns, "links", values)
            columns.append(o[1:])
        return out.select(*columns)
