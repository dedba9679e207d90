"""Lineages: rank filter, long to wide, ambiguous names, ancestors."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.operators.tables import duplicate_groups
from taxograph.plans.session import shared_dir


def rank_filter(long: DataFrame, ranks: dict[str, str] = V.RANK_ENTITIES, column: str = "hTaxRank") -> DataFrame:
    """Rows whose rank is one of the named entities."""
    return long.filter(F.col(column).isin(*ranks))


def align(long: DataFrame, ranks: dict[str, str] = V.RANK_ENTITIES, order: str | Column = "row_id") -> DataFrame:
    """(WdID, WdName, kingdom ... species): the first non-null name of each rank; rows without id or name are dropped.

    One aggregate with a fixed list of ranks; a taxon's rows may come in any number of parts.
    """
    rows = long.filter("WdID is not null and WdName is not null")

    def first(rank, entities):
        return F.min_by("hTaxName", F.when(F.col("hTaxRank").isin(*entities) & F.col("hTaxName").isNotNull(), F.col(order) if isinstance(order, str) else order)).alias(rank)

    by_rank = {r: [e for e, name in ranks.items() if name == r] for r in dict.fromkeys(ranks.values())}
    return rows.groupBy("WdID", "WdName").agg(*[first(r, e) for r, e in by_rank.items()])


def ambiguous_names(aligned: DataFrame) -> DataFrame:
    """All lineages whose name several taxa share, sorted by name."""
    return duplicate_groups(aligned, "WdName", ["WdID"])


def ancestor_closure(edges: DataFrame, child: str = "child", parent: str = "parent", checkpoint: str | None = None) -> DataFrame:
    """(node, ancestor): the reflexive and transitive closure of a parent relation, cycles allowed.

    The paths double in length each round until a round finds no new pair: paths of exactly 2^k steps are
    followed by all of up to 2^k, so that a tree gives each pair once. Rounds are written to the checkpoint
    folder, so that plans stay short and lost executors cost one round. Pairs are dealt by their ends before
    they are made distinct: small files hold many pairs, and a task would gather all that it reads.
    """
    spark = edges.sparkSession
    root = f"{(checkpoint or shared_dir(spark)).rstrip('/')}/closure-{uuid.uuid4().hex}"

    def kept(df: DataFrame, name: str) -> tuple[DataFrame, int]:
        seen = Observation()
        df.repartition("node", "ancestor").distinct().observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}"), seen.get["n"]

    def further(steps: DataFrame, more: DataFrame) -> DataFrame:
        ends = more.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("further"))
        return steps.join(ends, "ancestor").select("node", F.col("further").alias("ancestor")).filter("node <> ancestor")

    pairs = edges.select(F.col(child).alias("node"), F.col(parent).alias("ancestor")).filter("node is not null and ancestor is not null and node <> ancestor")
    pairs, size = kept(pairs, "0")
    exact, turn = pairs, 0
    while True:
        turn += 1
        pairs, grown = kept(pairs.union(further(exact, pairs)), str(turn))
        if grown == size:
            break
        exact, size = kept(further(exact, exact), f"exact-{turn}")[0], grown
    nodes = edges.select(F.col(child).alias("node")).union(edges.select(F.col(parent).alias("node"))).filter("node is not null").distinct()
    return pairs.union(nodes.select("node", F.col("node").alias("ancestor")))


def reachable(edges: DataFrame, starts: DataFrame, report: list[int] | None = None) -> DataFrame:
    """(node, ancestor): all that is reached from the starts over edges (child, parent), themselves included.

    Rounds follow new pairs only, from the starts alone, and end when a round finds none; cycles and
    several parents are allowed. Each round is written, so that plans stay short and a lost executor
    costs one round. report: gets the new pairs of each round.
    """
    spark = edges.sparkSession
    root = f"{shared_dir(spark)}/reach-{uuid.uuid4().hex}"
    steps = edges.toDF("ancestor", "further").filter("ancestor <> further").distinct()
    steps.write.parquet(f"{root}/edges")
    steps = spark.read.parquet(f"{root}/edges")
    first = starts.toDF("node").filter("node is not null").distinct()
    new, turn, known = first.select("node", F.col("node").alias("ancestor")), 0, None
    while True:
        seen = Observation()
        new.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/new/turn={turn}")
        found = seen.get["n"]
        if report is not None:
            report.append(found)
        known = spark.read.schema(new.schema).parquet(*[f"{root}/new/turn={k}" for k in range(turn + 1)])
        if not found:
            return known
        last = spark.read.schema(new.schema).parquet(f"{root}/new/turn={turn}")
        further = last.join(steps, "ancestor").select("node", F.col("further").alias("ancestor")).repartition("node", "ancestor").distinct()
        new, turn = further.join(known, ["node", "ancestor"], "left_anti"), turn + 1
