"""Term matching by embeddings: a pluggable embedder, cosine similarity, the best label per term.

The reference model of sentence embeddings is not available offline. HashedTrigrams is a stand-in
(its scores differ from any trained model's); whatever maps strings to vectors can take its place.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxograph.functions import scalars as S
from taxograph.plans.session import arrow_rows, shared_dir

Embedder = Callable[[list[str]], np.ndarray]


class HashedTrigrams:
    """Counts of hashed character trigrams, of unit length."""

    def __init__(self, dims: int = 256):
        self.dims = dims

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dims), dtype="f4")
        for row, text in zip(out, texts, strict=True):
            padded = f"  {text.lower()} "
            for k in range(len(padded) - 2):
                h = 2166136261
                for b in padded[k : k + 3].encode("utf-8", "surrogatepass"):
                    h = (h ^ b) * 16777619 & 0xFFFFFFFF
                row[h % self.dims] += 1.0
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)


def embedded(df: DataFrame, text: str, embedder: Embedder, out: str = "vector") -> DataFrame:
    """df with the vector of a text column, by Arrow batches; null texts have none."""

    @F.pandas_udf("array<float>")
    def embed(batch: pd.Series) -> pd.Series:
        known = batch.notna()
        made = iter(embedder(batch[known].tolist()))
        return pd.Series([next(made) if k else None for k in known])

    return df.withColumn(out, embed(F.col(text)))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two vectors; null for a zero vector."""
    return dot(a, b) / F.nullif(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(0.0))


#: Pivots that labels gather around, at most; labels in a block, about; terms in a pack.
PIVOTS, BLOCK_LABELS, PACK = 1024, 1024, 512
#: Bytes of the labels that a task holds, as doubles. Rows in an Arrow batch: of single vectors, of packs and blocks.
GROUP_BYTES, VECTOR_ROWS, PACK_ROWS = 32 << 20, 1024, 16


def _units(vectors: pd.Series) -> np.ndarray:
    m = np.stack(vectors.to_numpy()).astype("f8")
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def _angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


@dataclass
class Blocks:
    """Labels stored by block: a pivot and the labels nearest to it, within an angle of it.

    frame: (block, part, ids, bars, matrix), a row a part; about BLOCK_LABELS labels a part. pivots, radius,
    parts and sizes are numbers of the blocks, PIVOTS at most whatever the labels are.
    """

    frame: DataFrame
    pivots: np.ndarray
    ids: list
    barred: np.ndarray | None
    radius: np.ndarray
    parts: np.ndarray
    sizes: np.ndarray

    def groups(self) -> list[list[tuple[int, int]]]:
        """(block, part) of each group: parts in order, together of about GROUP_BYTES."""
        out, held = [], GROUP_BYTES
        for block, parts in enumerate(self.parts.tolist()):
            for part in range(parts):
                if held >= GROUP_BYTES:
                    out.append([])
                    held = 0
                out[-1].append((block, part))
                held += 8 * self.pivots.shape[1] * int(self.sizes[block]) // parts
        return out


def label_blocks(labels: DataFrame, vector: str, order: str, barred: str | None = None) -> Blocks:
    """Cut labels into blocks around some of them, chosen by hash, and store them in the shared folder."""
    spark = labels.sparkSession
    root = f"{shared_dir(spark)}/labels-{uuid.uuid4().hex}"
    rows = labels.select(F.col(order).alias("id"), F.col(vector).alias("vector"), F.col(barred or order).alias("barred")).filter(F.size("vector") > 0)
    rows.write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    few = rows.orderBy(F.xxhash64("id"), "id").limit(min(PIVOTS, math.isqrt(rows.count()) + 1)).toPandas()  # PIVOTS rows at most
    if not len(few):
        return Blocks(rows, np.empty((0, 0)), [], None, np.empty(0), np.empty(0, "i8"), np.empty(0, "i8"))
    pivots, kind = _units(few["vector"]), rows.schema["id"].dataType.simpleString()

    def assign(batches):
        for b in batches:
            if len(b):
                c = _units(b["vector"]) @ pivots.T
                yield pd.DataFrame({"id": b["id"], "vector": b["vector"], "barred": b["barred"], "block": c.argmax(axis=1).astype("i4"), "angle": _angles(c.max(axis=1))})

    with arrow_rows(spark, VECTOR_ROWS):
        rows.mapInPandas(assign, f"id {kind}, vector {rows.schema['vector'].dataType.simpleString()}, barred {rows.schema['barred'].dataType.simpleString()}, block int, angle double").write.parquet(f"{root}/assigned")
    near = spark.read.parquet(f"{root}/assigned")
    radius, parts, sizes = np.full(len(few), -1.0), np.zeros(len(few), "i8"), np.zeros(len(few), "i8")
    for r in near.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.max("angle").alias("radius")).collect():  # a row a pivot
        radius[r["block"]], parts[r["block"]], sizes[r["block"]] = r["radius"], -(-r["n"] // BLOCK_LABELS), r["n"]
    of = F.element_at(F.array(*[F.lit(int(n)) for n in parts]), F.col("block") + 1)
    cut = near.withColumn("part", F.pmod(F.xxhash64("id"), F.greatest(of, F.lit(1))).cast("int"))
    blocks = cut.groupBy("block", "part").agg(F.array_sort(F.collect_list(F.struct("id", "vector", "barred"))).alias("l"))
    blocks.select("block", "part", F.col("l.id").alias("ids"), F.col("l.barred").alias("bars"), F.flatten("l.vector").alias("matrix")).write.parquet(f"{root}/blocks")
    return Blocks(spark.read.parquet(f"{root}/blocks"), pivots, few["id"].tolist(), few["barred"].to_numpy(), radius, parts, sizes)


def best_matches(terms: DataFrame, labels: DataFrame, keys: list[str], label_columns: list[str], vector: str = "vector", order: str = "label_id", exclude_equal: tuple[str, str] | None = None, decimals: int | None = None, report: dict | None = None) -> DataFrame:
    """(keys..., label columns..., score): for each term the label of highest cosine; of equals the first by order.

    Labels are stored in blocks. A term meets only the blocks that can hold its best label: the angle to
    a block's pivot less the block's radius bounds every cosine in it, and the best pivot, a label itself,
    gives a score to beat. Blocks go to tasks in groups of GROUP_BYTES, terms in packs to the groups that they
    need, so that a term is sent once a group and a task holds one group and a few packs, whatever the
    tables are; a group's packs are dealt to as many tasks as keep all partitions busy. The best of a term's
    groups is taken at the end.

    order: unique ids of the labels, numbers. decimals rounds scores before they are compared.
    exclude_equal: (term column, label column) that must differ. report: gets the pairs of terms and
    blocks in all and those that met.
    """
    spark = terms.sparkSession
    blocks = label_blocks(labels, vector, order, exclude_equal and exclude_equal[1])
    root = f"{shared_dir(spark)}/terms-{uuid.uuid4().hex}"
    own = terms.select(*keys, F.col(vector).alias("__vector"), (F.col(exclude_equal[0]) if exclude_equal else F.lit(None).cast("long")).alias("__barred")).filter(F.size("__vector") > 0)
    with arrow_rows(spark, VECTOR_ROWS):
        own.withColumn("__term", F.monotonically_increasing_id()).write.parquet(f"{root}/rows")
    own = spark.read.parquet(f"{root}/rows")
    names, kinds = [f.name for f in labels.schema.fields if f.name in label_columns], {f.name: f.dataType.simpleString() for f in own.schema.fields}
    pivots, radius, parts, pivot_barred = blocks.pivots, blocks.radius, blocks.parts, blocks.barred
    slack = 1e-9 + (0.0 if decimals is None else 10.0**-decimals)

    groups = blocks.groups()
    blocks_of = [sorted({block for block, _ in g}) for g in groups]
    first_in = [np.array([(block, 0) in g for block in of]) for g, of in zip(groups, blocks_of, strict=True)]
    slices = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // max(1, len(groups)))

    def send(batches):
        for b in batches:
            if not len(b) or not len(pivots):
                continue
            u, who, barred = _units(b["__vector"]), b["__term"].to_numpy(), b["__barred"].to_numpy()
            c = u @ pivots.T
            known = np.where(barred[:, None] == pivot_barred[None, :], -2.0, c) if exclude_equal else c
            beat = known.max(axis=1) - slack
            needed = (np.cos(np.maximum(_angles(c) - radius[None, :], 0.0)) >= beat[:, None]) & (parts > 0)[None, :]
            for group, of in enumerate(blocks_of):
                mine = needed[:, of]
                which, out = np.flatnonzero(mine.any(axis=1)), []
                for at in range(0, len(which), PACK):
                    some = which[at : at + PACK]
                    slice_ = int(who[some[0]]) // PACK * 2654435761 % (1 << 32) * slices >> 32
                    out.append((group, slice_, who[some], u[some].tobytes(), barred[some], np.packbits(mine[some]).tobytes(), int(mine[some][:, first_in[group]].sum())))
                if out:
                    yield pd.DataFrame(out, columns=["group", "slice", "terms", "units", "barred", "needs", "met"])

    packs = own.select("__term", "__vector", "__barred").mapInPandas(send, f"group int, slice int, terms array<bigint>, units binary, barred array<{kinds['__barred']}>, needs binary, met long")
    with arrow_rows(spark, VECTOR_ROWS):
        packs.write.parquet(f"{root}/packs")
    packs = spark.read.parquet(f"{root}/packs")
    if report is not None:
        report |= {"pairs": own.count() * int((parts > 0).sum()), "met": packs.agg(F.coalesce(F.sum("met"), F.lit(0))).first()[0]}

    def score(batches):
        cell, held = None, []
        for b in batches:
            for group, slice_, side, block, ids, bars, matrix, who, units, barred, needs in zip(*(b[c] for c in ("group", "slice", "side", "block", "ids", "bars", "matrix", "terms", "units", "barred", "needs")), strict=True):
                if (group, slice_) != cell:
                    cell, held = (group, slice_), []
                if side == 0:
                    m = np.asarray(matrix, dtype="f8").reshape(len(ids), -1)
                    held.append((blocks_of[group].index(block), np.asarray(ids), np.asarray(bars), m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)))
                    continue
                u, barred = np.frombuffer(units, "f8").reshape(len(who), -1), np.asarray(barred)
                mine = np.unpackbits(np.frombuffer(needs, "u1"), count=len(who) * len(blocks_of[group])).reshape(len(who), -1).astype(bool)
                best, found = np.full(len(who), -np.inf), np.zeros(len(who), held[0][1].dtype)
                for column, ids_, bars_, m in held:
                    which = np.flatnonzero(mine[:, column])
                    if not len(which):
                        continue
                    s = u[which] @ m.T
                    if decimals is not None:
                        s = np.round(s, decimals)
                    if exclude_equal:
                        s[barred[which][:, None] == bars_[None, :]] = -np.inf
                    at = s.argmax(axis=1)
                    top, where = s[np.arange(len(at)), at], ids_[at]
                    won = (top > best[which]) | ((top == best[which]) & (where < found[which]))
                    best[which[won]], found[which[won]] = top[won], where[won]
                some = np.isfinite(best)
                yield pd.DataFrame({"__term": np.asarray(who)[some], "at": found[some], "score": best[some]})

    kind = labels.schema[order].dataType.simpleString()
    if not blocks.ids:
        found = spark.createDataFrame([], f"__term bigint, at {kind}, score double")
    else:
        of = spark.createDataFrame([(block, part, g) for g, held in enumerate(groups) for block, part in held], "block int, part int, group int")
        stored = blocks.frame.join(F.broadcast(of), ["block", "part"])  # a row a part
        empty = lambda names, like: [F.lit(None).cast(like.schema[n].dataType).alias(n) for n in names]
        here, there = ["block", "ids", "bars", "matrix"], ["terms", "units", "barred", "needs"]
        sent = stored.select("group", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))).alias("slice"), F.lit(0).alias("side"), *here, *empty(there, packs))
        met = sent.union(packs.select("group", "slice", F.lit(1).alias("side"), *empty(here, stored), *there))
        met = met.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "group", "slice").sortWithinPartitions("group", "slice", "side")
        with arrow_rows(spark, PACK_ROWS):
            met.mapInPandas(score, f"__term bigint, at {kind}, score double").write.parquet(f"{root}/found")
        found = spark.read.parquet(f"{root}/found")
    best = found.groupBy("__term").agg(F.min(F.struct((-F.col("score")).alias("score"), "at")).alias("b"))
    best = best.select("__term", (-F.col("b.score")).alias("score"), F.col("b.at").alias(order))
    out = own.select("__term", *keys).join(best, "__term").join(labels.select(order, *[c for c in names if c != order and c not in keys]), order)
    return out.select(*keys, *names, "score")


def match_terms(lines: DataFrame, ontology: DataFrame, embedder: Embedder | None = None) -> DataFrame:
    """(term, label, main_label, uri, score) of each term of each line.

    lines: (line). ontology: (label, uri, main_label). Terms stand between slashes and commas.
    """
    embedder = embedder or HashedTrigrams()
    spark, root = lines.sparkSession, f"{shared_dir(lines.sparkSession)}/embedded-{uuid.uuid4().hex}"  # stored, so that labels keep their numbers
    terms = lines.select(F.explode(S.split_terms(F.col("line"))).alias("term"))
    with arrow_rows(spark, VECTOR_ROWS):
        # equal terms have one vector and one match; stored, or else a later filter would embed before they are distinct
        embedded(terms.distinct(), "term", embedder).write.parquet(f"{root}/terms")
        embedded(ontology.withColumn("label_id", F.monotonically_increasing_id()), "label", embedder).write.parquet(f"{root}/labels")
    best = best_matches(spark.read.parquet(f"{root}/terms"), spark.read.parquet(f"{root}/labels"), ["term"], ["label", "main_label", "uri"])
    return terms.join(best, "term")
