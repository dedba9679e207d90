"""Merkle manifest of a dataset: a tree per group, a tree over the groups' roots, proofs of every row.

H is SHA-256 in lower-case hex over concatenated texts, digests as hex text. While a level has
several nodes, each run of FANOUT consecutive nodes becomes the H of its members; the last run may be
shorter and is hashed without padding, even if it has one member. What remains is the root.

Rows are sorted by a range exchange, stored, and numbered inside their group from counts per
partition. Each partition then pushes its leaves on a mountain-range stack: a run that fills up
inside the partition is hashed and carried to the next level like the digit of a counter; what the
partition's edges cut off (a run that began before it, the open peaks at its end) is given out as a
fragment. Fragments of a run meet by a hash aggregate, level by level, at most FANOUT of them; there
are as many such rounds as the largest group has levels. Proofs go the other way: a run meets the
proof of its node by an equi-join with one row on each side, and hands it to its members.

Defined cases: a null field is `-`, so a null text differs from an empty one; null groups are a group
that comes first, null ids come first in their group; rows with equal ids are ordered by their leaf
digests and equal rows are interchangeable; a null id is never altered; a group of one row has its
leaf as root, and a dataset of one group has that group's root; an empty table gives an empty result;
fields are read by name and only these, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from taxograph.llm.common import by_ids, partitions, staged

FANOUT, DIGEST = 16, 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NODES = "key string, level int, run bigint, first int, members string"
PATH = "array<struct<left:string,right:string>>"
FLUSH = 2048


def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and the value; `-` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def group_key(value: Column) -> Column:
    """Never null and in the order of the groups: null first, then by UTF-8 bytes."""
    return F.coalesce(F.concat(F.lit("s"), value.cast("string")), F.lit(""))


class Mountains:
    """The stack of one stretch of consecutive nodes: per level the open run's first index and members."""

    def __init__(self, emit, fanout: int = FANOUT):
        self.emit, self.fanout, self.levels = emit, fanout, []

    def push(self, index: int, digest: str, level: int = 0) -> None:
        if level == len(self.levels):
            self.levels.append((index, []))
        first, held = self.levels[level]
        if not held:
            first = index
            self.levels[level] = first, held
        held.append(digest)
        if index % self.fanout == self.fanout - 1:
            members = "".join(held)
            self.levels[level] = index + 1, []
            self.emit(level, index // self.fanout, first % self.fanout, members)
            if first % self.fanout == 0:
                self.push(index // self.fanout, hashlib.sha256(members.encode()).hexdigest(), level + 1)

    def close(self) -> None:
        """Give out the open runs; some may be the short last run of their level."""
        for level, (first, held) in enumerate(self.levels):
            if held:
                self.emit(level, first // self.fanout, first % self.fanout, "".join(held))
        self.levels = []


def _climb(fanout: int):
    """For mapInArrow over (key, idx, digest): the completed runs and the fragments of each stretch."""

    def run(batches):
        out: list[tuple] = []
        key, upto, stack = None, -1, None

        def record():
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string()), strict=True)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in NODES.split(", ")])

        for b in batches:
            for k, i, d in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if stack is None or k != key or i != upto + 1:
                    if stack is not None:
                        stack.close()
                    key = k
                    stack = Mountains(lambda *node, k=k: out.append((k, *node)), fanout)
                stack.push(i, d)
                upto = i
                if len(out) >= FLUSH:
                    yield record()
                    out.clear()
        if stack is not None:
            stack.close()
        if out:
            yield record()

    return run


@dataclass
class Forest:
    """A tree per key. leaves: the rows with idx; runs: (key, level, run, members); roots: (key, level, root)."""

    leaves: DataFrame
    runs: DataFrame
    roots: DataFrame
    levels: int
    fanout: int


def forest(rows: DataFrame, order: list[str], fanout: int = FANOUT) -> Forest:
    """Trees over rows (key, digest, ...): one per key, leaves by the columns of order, nulls first."""
    spark = rows.sparkSession
    by = [F.col("key"), *(F.col(c).asc_nulls_first() for c in order), F.col("digest"), F.col("__tie")]
    # equal rows spread over ranges by the last key; the sort's input is stored, so that it is the same each time
    rows = staged(rows, "leaves").withColumn("__tie", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).drop("__tie").withColumn("at", F.monotonically_increasing_id())
    placed = staged(ranged, "ordered").withColumn("part", F.shiftright("at", 33))
    pairs = placed.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("low"))
    before = F.sum("n").over(W.partitionBy("key").orderBy("part")) - F.col("n")
    pairs = staged(pairs.withColumn("before", before), "stretches")
    leaves = by_ids(placed, pairs.select("part", "key", (F.col("low") - F.col("before")).alias("zero")), ["part", "key"], "left")
    leaves = leaves.withColumn("idx", F.col("at") - F.col("zero")).drop("part", "at", "zero")
    totals = staged(pairs.groupBy("key").agg(F.sum("n").alias("n")), "totals")

    climbed = leaves.select("key", "idx", "digest").sortWithinPartitions("key", "idx").mapInArrow(_climb(fanout), NODES)
    nodes = staged(climbed, "nodes")
    full = (F.col("first") == 0) & (F.length("members") == fanout * DIGEST)
    runs = nodes.filter(full).select("key", "level", "run", "members")
    open_ = by_ids(nodes.filter(~full), totals, "key", "left")
    most, levels = totals.agg(F.max("n")).first()[0] or 1, 0
    while fanout**levels < most:
        levels += 1
    carried, roots = None, None
    for level in range(levels + 1):
        here = open_.filter(F.col("level") == level)
        here = here if carried is None else here.unionByName(carried)
        alone = F.col("n") <= fanout**level  # one node on this level
        root = here.filter(alone).select("key", "level", F.col("members").alias("root"))
        roots = root if roots is None else roots.union(root)
        if level == levels:
            break
        parts = F.array_sort(F.collect_list(F.struct("first", "members")))
        met = here.filter(~alone).groupBy("key", "run", "n").agg(F.array_join(F.transform(parts, lambda x: x["members"]), "").alias("members"))
        met = staged(met.select("key", F.lit(level).alias("level"), "run", "members", "n"), "met")
        runs = runs.union(met.select("key", "level", "run", "members"))
        carried = met.select("key", (F.col("level") + 1).alias("level"), F.expr(f"run div {fanout}").alias("run"), (F.col("run") % fanout).cast("int").alias("first"), F.sha2("members", 256).alias("members"), "n")
    return Forest(leaves, runs, staged(roots, "roots"), levels, fanout)


def _step(members: Column, position: Column) -> Column:
    """The siblings of a member, to its left and to its right."""
    at = (position * DIGEST).cast("int")
    return F.struct(F.substring(members, F.lit(1), at).alias("left"), F.substring(members, at + DIGEST + 1, F.length(members)).alias("right"))


def paths(trees: Forest, above: DataFrame | None = None) -> DataFrame:
    """The leaves with root (of their tree) and path: the siblings level by level, up to what is above.

    above: (key, path) from each root on; none if the roots are the end.
    """
    roots = trees.roots.join(above, "key") if above is not None else trees.roots.withColumn("path", F.expr(f"cast(array() as {PATH})"))
    climb = lambda run: F.concat(F.array(run), F.col("path"))
    state = None
    for level in range(trees.levels, 0, -1):
        here = roots.filter(F.col("level") == level).select("key", F.lit(0).cast("long").alias("run"), "path", "root")
        if state is not None:
            met = trees.runs.filter(F.col("level") == level).join(state, ["key", "run"])
            spread = met.select("key", "run", "members", "path", "root", F.explode(F.sequence(F.lit(0), (F.length("members") / DIGEST).cast("int") - 1)).alias("place"))
            here = here.union(spread.select("key", F.col("run") * trees.fanout + F.col("place"), climb(_step(F.col("members"), F.col("place"))), "root"))
        state = here
    lone = roots.filter(F.col("level") == 0).select("key", F.lit(0).cast("long").alias("run"), F.lit(None).cast("string").alias("members"), "path", "root")
    first = lone if state is None else lone.union(trees.runs.filter(F.col("level") == 0).join(state, ["key", "run"]).select("key", "run", "members", "path", "root"))
    leaves = trees.leaves.withColumn("run", F.expr(f"idx div {trees.fanout}")).join(first, ["key", "run"])
    own = F.when(F.col("members").isNull(), F.col("path")).otherwise(climb(_step(F.col("members"), F.col("idx") % trees.fanout)))
    return leaves.withColumn("path", own).drop("run", "members")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings along its path give."""
    return F.aggregate(path, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def _with_key(df: DataFrame, group_col: str, fields: tuple[str, ...], carried: list[Column]) -> DataFrame:
    return df.select(group_key(F.col(group_col)).alias("key"), leaf_digest([F.col(c) for c in fields]).alias("digest"), *carried)


def proofs(df: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, altered: Column | None = None, fanout: int = FANOUT) -> DataFrame:
    """(id, leaf, altered, subroot, root, path) of every row; altered: a digest that is carried along."""
    carried = [F.col(id_col).alias("id"), (F.lit(None) if altered is None else altered).cast("string").alias("altered")]
    trees = forest(_with_key(df, group_col, fields, carried), ["id"], fanout)
    crown = forest(trees.roots.select(F.lit("").alias("key"), F.col("root").alias("digest"), F.col("key").alias("group")), ["group"], fanout)
    root = crown.roots.select("root").first()
    # stored, so that the plan of the documents' paths does not hold that of the groups'
    above = staged(paths(crown).select(F.col("group").alias("key"), "path"), "above")
    found = paths(trees, above)
    return found.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "altered", F.col("root").alias("subroot"), F.lit(root["root"] if root else None).cast("string").alias("root"), "path")


def tampered_leaf(df: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", text_col: str = "text", one_in: int = 5) -> Column:
    """The leaf of a row with its text in lower case (A-Z), where one_in divides the CRC of the decimal id; else null."""
    lowered = [F.translate(F.col(c), UPPER, LOWER) if c == text_col else F.col(c) for c in fields]
    return F.when(F.crc32(F.col(id_col).cast("string").cast("binary")) % one_in == 0, leaf_digest(lowered))


def tamper_check(df: DataFrame, **columns) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified): which altered rows the manifest finds."""
    id_col = columns.get("id_col", "doc_id")
    found = proofs(df, altered=tampered_leaf(df, columns.get("fields", FIELDS), id_col), **columns)
    found = found.withColumn("folded_root", fold(F.coalesce("altered", "leaf"), F.col("path")))
    return found.select(id_col, "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def manifest(df: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields: tuple[str, ...] = FIELDS, fanout: int = FANOUT) -> DataFrame:
    """(key, level, run, digest, members): the node records of the groups' trees, without the leaves' rows.

    Two manifests differ exactly in the nodes above changed rows, see changed_runs().
    """
    runs = forest(_with_key(df, group_col, fields, [F.col(id_col).alias("id")]), ["id"], fanout).runs
    return runs.select("key", "level", "run", F.sha2("members", 256).alias("digest"), "members")


def changed_runs(old: DataFrame, new: DataFrame) -> DataFrame:
    """(key, run) of the runs of leaves that differ between two manifests of rows in the same order."""
    bottom = lambda m: m.filter("level = 0").select("key", "run", "digest")
    both = bottom(old).join(bottom(new).withColumnRenamed("digest", "now"), ["key", "run"], "full")
    return both.filter(~F.col("digest").eqNullSafe(F.col("now"))).select("key", "run")
