"""Exact top-k by inner product with no-random-access aggregation over sorted lists.

Vectors are cut into packs. In each pack every component is one sorted list, read from its top for
positive query components and from its bottom for negative ones. Lists are read sequentially and in
step, a depth at a time, for a block of queries: a vector's seen components count exactly, its
unseen ones lie between the end of the list and the value read last, which gives lower and upper
bounds. Vectors whose upper bound is under the k-th best lower bound, of this pack or of packs
before it, are out; when few remain, or the lists end, their final scores are resolved from their
remaining components. Bounds of a block of queries and a tile of vectors are two matrix products.

Query packs meet vector packs by an equi-join on (length, query pack, salt), so that no task holds a
side; partial results are k rows per query and salt.

Score: inner product of the components turned into floor(scale * x), as whole numbers, exact; a
score beyond 64 bits raises OverflowError.

Defined cases: rows with a null id, a null or empty vector, or a null or non-finite component take
no part; vectors of different lengths are not compared; a query's own id is never among its
results; a query row that is repeated gets results for each; repeated candidates rank one by one;
ties go to the smaller id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from taxograph.llm.common import arrow_rows, pack, partitions, small_batches, staged, unpack

SCALE, K = 64, 20
DEPTHS = (0.5, 0.75, 1.0)
TILE, QUERY_TILE = 4096, 256
PACK_LEAST, PACK_MOST, QUERY_LEAST, QUERY_MOST, SALTS = 2048, 65536, 256, 8192, 4
PACK = "dim int, bucket bigint, ids binary, vectors binary, width int"


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & fine


def packs(rows: DataFrame, buckets: int, most: int) -> DataFrame:
    """rows (id, vector array<bigint>) as packs of at most `most` rows of one length and bucket."""
    spread = rows.withColumn("dim", F.size("vector")).withColumn("bucket", F.pmod(F.xxhash64("id"), F.lit(buckets)))
    spread = spread.select("dim", "bucket", "id", "vector").repartition(max(partitions(rows.sparkSession), 1), "dim", "bucket")

    def one(dim, bucket, ids, vectors):
        v = np.concatenate(vectors).reshape(-1, dim)
        kind = next(t for t in ("i1", "i2", "i4", "i8") if not v.size or (v.min() >= np.iinfo(t).min and v.max() <= np.iinfo(t).max))
        return pa.RecordBatch.from_arrays(
            [pa.array([dim], pa.int32()), pa.array([bucket]), pa.array([pack(np.array(ids, dtype="i8"))], pa.binary()), pa.array([pack(v.astype(kind))], pa.binary()), pa.array([np.dtype(kind).itemsize], pa.int32())],
            ["dim", "bucket", "ids", "vectors", "width"],
        )

    def build(batches):
        held: dict[tuple, tuple[list, list]] = {}
        for b in batches:
            dims, bucket, ids = (np.asarray(b.column(k)) for k in range(3))
            lists = b.column(3)
            values, ends = np.asarray(lists.flatten()), np.cumsum(dims.astype("i8"))
            for key in set(zip(dims.tolist(), bucket.tolist(), strict=True)):
                at = np.flatnonzero((dims == key[0]) & (bucket == key[1]))
                own_ids, own = held.setdefault(key, ([], []))
                own_ids.extend(ids[at].tolist())
                own.append(values[(ends[at] - key[0])[:, None] + np.arange(key[0])].ravel())
                if len(own_ids) >= most:
                    yield one(*key, own_ids, own)
                    del held[key]
        for key, (own_ids, own) in held.items():
            yield one(*key, own_ids, own)

    return spread.mapInArrow(build, PACK)


class Lists:
    """The sorted lists of a tile of vectors, as the ranks of their entries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x, n = ids, x, len(x)
        order = np.argsort(x, axis=0, kind="stable")
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(n)[:, None], axis=0)
        self.sorted = np.take_along_axis(x, order, axis=0)
        self.by_id = np.argsort(ids, kind="stable")
        self.bounds: dict[float, tuple[np.ndarray, np.ndarray]] = {}

    def at_depth(self, depth: float, kind) -> tuple[np.ndarray, np.ndarray]:
        """(upper, lower) factors: what each component counts as once so much of its list is read, for positive and negative query components side by side."""
        if depth not in self.bounds:
            n = len(self.x)
            read = max(1, round(depth * n))
            top, bottom = self.rank >= n - read, self.rank < read
            upper = [np.where(top, self.x, self.sorted[n - read]), np.where(bottom, self.x, self.sorted[read - 1])]
            lower = [np.where(top, self.x, self.sorted[0]), np.where(bottom, self.x, self.sorted[-1])]
            self.bounds[depth] = tuple(np.concatenate(v, axis=1).astype(kind).T.copy() for v in (upper, lower))
        return self.bounds[depth]

    def own(self, query_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, vector) pairs of equal ids."""
        known = self.ids[self.by_id]
        a, z = np.searchsorted(known, query_ids, "left"), np.searchsorted(known, query_ids, "right")
        q = np.repeat(np.arange(len(query_ids)), z - a)
        inner = np.arange(len(q)) - np.repeat(np.cumsum(z - a) - (z - a), z - a)
        return q, self.by_id[a[q] + inner]


def exact_kind(q: np.ndarray, x: np.ndarray):
    """A type whose matrix products of q and x are exact."""
    most = float(np.abs(q).max(initial=0).astype(float)) * float(np.abs(x).max(initial=0).astype(float)) * q.shape[1]
    return "f4" if most < 1 << 24 else "f8" if most < 1 << 53 else object


def search_tile(query_ids: np.ndarray, q: np.ndarray, lists: Lists, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, vector, score): all vectors of the tile that can be among the k best of a query.

    floor: per query the k-th best score of earlier tiles, or -inf.
    """
    kind, n = exact_kind(q, lists.x), len(lists.x)
    if kind is object:
        scores = q.astype(object) @ lists.x.astype(object).T
        if abs(scores).max(initial=0) >= 1 << 63:
            raise OverflowError("a score needs more than 64 bits")
        who, at = (v.ravel() for v in np.indices(scores.shape))
        mine = np.zeros(scores.shape, dtype=bool)
        mine[lists.own(query_ids)] = True
        keep = ~mine.ravel()
        return who[keep], at[keep], scores.ravel()[keep].astype("i8")
    halves = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype(kind)
    own = lists.own(query_ids)
    open_, found = np.arange(len(q)), []
    for depth in DEPTHS:
        upper, lower = (halves[open_] @ f for f in lists.at_depth(depth, kind))
        place = np.full(len(q), -1)
        place[open_] = np.arange(len(open_))
        mine = place[own[0]] >= 0
        for bound in (upper, lower):
            bound[place[own[0][mine]], own[1][mine]] = -np.inf
        least = floor[open_]
        if n >= k:
            least = np.maximum(least, np.partition(lower, n - k, axis=1)[:, n - k])
        live = (upper >= least[:, None]) & (upper > -np.inf)
        few = (live.sum(axis=1) <= 4 * k) | (depth == DEPTHS[-1])
        who, at = np.nonzero(live[few])
        found.append((open_[few][who], at))
        open_ = open_[~few]
        if not len(open_):
            break
    who, at = (np.concatenate(v) for v in zip(*found, strict=True))
    return who, at, np.einsum("ij,ij->i", q[who].astype("i8"), lists.x[at].astype("i8"))


class Best:
    """The k best of each query of a pack so far."""

    def __init__(self, ids: np.ndarray, k: int):
        self.ids, self.k = ids, k
        self.who = self.vec = self.score = np.empty(0, "i8")
        self.floor = np.full(len(ids), -np.inf)

    def add(self, who: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        who, vec, score = (np.concatenate(x) for x in ((self.who, who), (self.vec, vec), (self.score, score)))
        order = np.lexsort((vec, -score, who))
        who, vec, score = who[order], vec[order], score[order]
        first = np.searchsorted(who, who, "left")
        keep = np.arange(len(who)) - first < self.k
        self.who, self.vec, self.score = who[keep], vec[keep], score[keep]
        last = np.flatnonzero(np.arange(len(who)) - first == self.k - 1)
        self.floor[who[last]] = score[last]


def top_k(df: DataFrame, k: int = K, query_every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): queries are the rows whose id is divisible by query_every."""
    spark = df.sparkSession
    small_batches(spark, 4096)
    vector = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col)).filter(F.col("id").isNotNull() & usable(F.col(vector_col))).select("id", vector.alias("vector"))
    asks = F.col("id") % query_every == 0
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count(F.when(asks, 1))).first()
    size = min(PACK_MOST, max(PACK_LEAST, n // 64))
    query_size = min(QUERY_MOST, max(QUERY_LEAST, n_queries // 8))
    query_packs = max(1, -(-n_queries // query_size))
    salts = min(SALTS, max(1, -(-n // size)))
    with arrow_rows(spark, 4096):
        x = staged(packs(rows, max(1, -(-n // size)), size), "vector-packs")
        q = staged(packs(rows.filter(asks), query_packs, query_size), "query-packs")
    q = q.select("dim", F.col("bucket").alias("ask"), F.col("ids").alias("q_ids"), F.col("vectors").alias("q_vectors"), F.col("width").alias("q_width"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    x = x.withColumn("salt", (F.col("bucket") % salts).cast("int")).withColumn("ask", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_packs - 1).cast("long"))))
    met = q.join(x, ["dim", "ask", "salt"]).select("dim", "salt", "q_ids", "q_vectors", "q_width", "ids", "vectors", "width")

    def search(batches):
        current, best, queries = None, None, None
        for b in batches:
            for dim, salt, q_ids, q_vectors, q_width, ids, vectors, width in zip(*(c.to_pylist() for c in b.columns), strict=True):
                mark = (dim, salt, hashlib.blake2b(q_ids + q_vectors, digest_size=6).digest())
                if mark != current:
                    if best is not None:
                        yield emit(current, best)
                    current, queries = mark, unpack(q_vectors, f"i{q_width}").reshape(-1, dim).astype("i8")
                    best = Best(unpack(q_ids, "i8"), k)
                known, values = unpack(ids, "i8"), unpack(vectors, f"i{width}").reshape(-1, dim).astype("i8")
                for at in range(0, len(known), TILE):
                    lists = Lists(known[at : at + TILE], values[at : at + TILE])
                    for first in range(0, len(queries), QUERY_TILE):
                        part = slice(first, first + QUERY_TILE)
                        who, vec, score = search_tile(best.ids[part], queries[part], lists, best.floor[part], k)
                        best.add(who + first, lists.ids[vec], score)
        if best is not None:
            yield emit(current, best)

    def emit(mark, best):
        row = int.from_bytes(mark[2])
        return pa.RecordBatch.from_arrays([pa.array((row * 8192 + best.who) & ((1 << 62) - 1), pa.int64()), pa.array(best.ids[best.who]), pa.array(best.vec), pa.array(best.score)], ["query_row", "query_id", "vec_id", "score"])

    with arrow_rows(spark, 8):
        partial = staged(met.mapInArrow(search, "query_row bigint, query_id bigint, vec_id bigint, score bigint"), "top-k")
    order = W.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
