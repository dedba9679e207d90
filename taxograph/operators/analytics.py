"""Counts, crosstabs, flows and networks over query results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from taxograph import vocab as V
from taxograph.functions import scalars as S
from taxograph.operators.tables import top


def value_counts(df: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """(column, n): how often each non-null value occurs; the k commonest, ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts if k is None else counts.orderBy(F.col("n").desc(), column).limit(k)


def distinct_per_group(df: DataFrame, group: str, value: str, k: int | None = None) -> DataFrame:
    """(group, n): distinct non-null values per non-null group."""
    counts = df.filter(F.col(group).isNotNull()).groupBy(group).agg(F.count_distinct(value).alias("n"))
    return counts if k is None else counts.orderBy(F.col("n").desc(), group).limit(k)


def summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """(group, n_records, n_values), joined on the key."""
    return value_counts(df, group).withColumnRenamed("n", "n_records").join(distinct_per_group(df, group, value).withColumnRenamed("n", "n_values"), group)


def crosstab_top(df: DataFrame, row: str, column: str, rows: int, columns: int, presence: bool = False) -> DataFrame:
    """Counts of the commonest rows by the commonest columns, zero where none; with presence 0 or 1.

    The heads are a bounded number of values and are read by the driver to fix the pivot's list.
    """
    kept = [r[0] for r in value_counts(df, row, rows).collect()]
    heads = [r[0] for r in value_counts(df, column, columns).collect()]
    table = df.filter(F.col(row).isin(kept)).groupBy(row)
    cell = lambda h: F.count(F.when(F.col(column) == h, 1))
    return table.agg(*[((cell(h) > 0).cast("int") if presence else cell(h)).alias(str(h)) for h in heads])


def pair_flow(df: DataFrame, a: str, b: str) -> DataFrame:
    """(a, b, n): how often two non-null values go together."""
    return df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def sankey(df: DataFrame, stages: list[str]) -> tuple[DataFrame, DataFrame]:
    """(nodes, links) of flows between neighbouring stages: nodes have an index from 0, links its pairs.

    The index numbers nodes by stage and name; the name table, not the data, goes through one task.
    """
    names = None
    for k, s in enumerate(stages):
        one = df.filter(F.col(s).isNotNull()).select(F.lit(k).alias("stage"), F.col(s).alias("name")).distinct()
        names = one if names is None else names.union(one)
    nodes = names.withColumn("index", F.row_number().over(W.orderBy("stage", "name")) - 1)
    links = None
    for k, (a, b) in enumerate(zip(stages, stages[1:], strict=False)):
        ends = [nodes.filter(F.col("stage") == k + d).select(F.col("name").alias(c), F.col("index").alias(n)) for d, c, n in ((0, a, "source"), (1, b, "target"))]
        one = pair_flow(df, a, b).join(ends[0], a).join(ends[1], b).select("source", "target", F.col("n").alias("value"))
        links = one if links is None else links.union(one)
    return nodes, links


def without_fungi(df: DataFrame, column: str, genera: tuple[str, ...] = V.FUNGAL_GENERA) -> DataFrame:
    return df.filter(~S.holds_any(F.col(column), genera))


def degrees(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(node, in_degree, out_degree, degree) over distinct directed edges; a loop adds one to each and two to the total."""
    once = edges.filter(F.col(source).isNotNull() & F.col(target).isNotNull()).select(F.col(source).alias("a"), F.col(target).alias("b")).distinct()
    ends = once.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")), F.struct(F.col("b").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))).alias("e"))
    return ends.groupBy("e.node").agg(F.sum("e.i").alias("in_degree"), F.sum("e.o").alias("out_degree"), F.count(F.lit(1)).alias("degree"))


def edge_weights(edges: DataFrame, source: str, target: str) -> DataFrame:
    """(source, target, weight): how often each directed edge occurs."""
    return pair_flow(edges, source, target).withColumnRenamed("n", "weight")


def species_sets(traits: DataFrame, metabolites: DataFrame, interactions: DataFrame, common: bool) -> DataFrame:
    """(species) that all three tables name, or any of them."""
    one = lambda df, c: df.filter(F.col(c).isNotNull()).select(F.col(c).alias("species")).distinct()
    pair = one(interactions, "sourceName").union(one(interactions, "targetName")).distinct()
    a, b = one(traits, "sourceName"), one(metabolites, "sourceName")
    return a.intersect(b).intersect(pair) if common else a.union(b).union(pair).distinct()


def network(traits: DataFrame, metabolites: DataFrame, interactions: DataFrame, common: bool = False) -> DataFrame:
    """(a, b, edge_type): undirected edges, once; of several types on one pair interaction, else metabolite, else trait."""
    species = species_sets(traits, metabolites, interactions, common)
    has = lambda df, c: df.join(species.withColumnRenamed("species", c), c, "left_semi")
    kinds = [
        (1, "trait", has(traits, "sourceName").select("sourceName", "tryDataLab")),
        (2, "metabolite", has(metabolites, "sourceName").select("sourceName", "wd_chem")),
        (3, "interaction", has(has(interactions, "sourceName"), "targetName").select("sourceName", "targetName")),
    ]
    edges = None
    for rank, kind, df in kinds:
        one = df.toDF("x", "y").filter("x is not null and y is not null").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"))
        edges = one if edges is None else edges.union(one)
    return edges.groupBy("a", "b").agg(F.max_by("kind", "rank").alias("edge_type"))


def top_species(traits: DataFrame, metabolites: DataFrame, interactions: DataFrame, n: int) -> DataFrame:
    """(species, score): the n species that most of the three tables name; ties by name."""
    return top(completeness(traits, metabolites, interactions), "score", n, "species")


def network_of(species: DataFrame, traits: DataFrame, metabolites: DataFrame, interactions: DataFrame) -> DataFrame:
    """The network of the given species alone, both ends of an interaction among them."""
    has = lambda df, c: df.join(species.select(F.col("species").alias(c)), c, "left_semi")
    return network(has(traits, "sourceName"), has(metabolites, "sourceName"), has(has(interactions, "sourceName"), "targetName"))


def network_summary(edges: DataFrame, species: DataFrame) -> DataFrame:
    """(n_nodes, n_species, n_edges, n_trait, n_metabolite, n_interaction)."""
    nodes = edges.select(F.col("a").alias("node")).union(edges.select("b")).union(species.select("species")).distinct()
    by = [F.count(F.when(F.col("edge_type") == k, 1)).alias(f"n_{k}") for k in ("trait", "metabolite", "interaction")]
    counts = edges.agg(F.count(F.lit(1)).alias("n_edges"), *by)
    return nodes.agg(F.count(F.lit(1)).alias("n_nodes")).join(species.agg(F.count(F.lit(1)).alias("n_species"))).join(counts)


def completeness(traits: DataFrame, metabolites: DataFrame, interactions: DataFrame) -> DataFrame:
    """(species, score): how many of the three tables name a species."""
    parts = [traits.select(F.col("sourceName").alias("species"), F.lit(1).alias("t")), metabolites.select("sourceName", F.lit(2)), interactions.select("sourceName", F.lit(3)), interactions.select("targetName", F.lit(3))]
    rows = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    return rows.filter("species is not null").groupBy("species").agg(F.count_distinct("t").alias("score"))


def connected_species(df: DataFrame, item: str, species: str = "sourceName") -> DataFrame:
    """(item, n): species that a trait or metabolite is connected to."""
    return distinct_per_group(df.filter(F.col(species).isNotNull()), item, species)


def synonym(df: DataFrame, names: tuple[str, ...]) -> str:
    """The first of the names that is a column of df."""
    for n in names:
        if n in df.columns:
            return n
    raise ValueError(f"none of the columns {', '.join(names)}")
