"""Importance resampling towards a target distribution: hashed word n-grams, gains, Gumbel top-k.

Features are single words and pairs of neighbours joined by a space, hashed to buckets by CRC-32. The
texts are never cut into Python strings: a batch's UTF-8 buffer is lower-cased and classified by a
lookup table, word bounds are where the class differs from that of the byte before, and the table-
driven CRC advances over all words at once, one byte of each a step; a pair goes on from the state of
its first word. Words beyond LONG bytes are taken by zlib, so that a step never serves one word alone.
The buffer is worked on in pieces of PIECE bytes that end between words; a pair may cross pieces.

Counts of both sides are tables of BUCKETS numbers. A document's weight is the mean gain of its
features, rounded down. Its score adds Gumbel noise drawn from the hash of its id, so that the highest
scores are a sample without replacement by weight, and the same in each run. Ranks come from a range
exchange and counts per partition.

Defined cases: null and empty texts have no features and weight 0; only documents of `least_words`
words take part in the draw; ties of scores go to the smaller id, null last; rows with equal ids and
scores are interchangeable; a null id hashes like an empty one; without target texts all t are 0; an
empty table gives an empty result; words and pairs never cross documents; columns are read by name.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window as W

from taxograph.llm.common import partitions, staged

BUCKETS, LEAST_WORDS, SEED, SHARE = 10_000, 20, 7, 25
PIECE, LONG = 1 << 21, 48


def _crc_table() -> np.ndarray:
    """The byte table of the reflected CRC-32 polynomial."""
    c = np.arange(256, dtype="u4")
    for _ in range(8):
        c = (c >> np.uint32(1)) ^ (np.uint32(0xEDB88320) * (c & np.uint32(1)))
    return c


CRC = _crc_table()
START = np.uint32(0xFFFFFFFF)
#: What each byte becomes (A-Z to a-z) and whether it belongs to a word [^\x00-\x2F\x3A-\x60\x7B-\x7F].
LOWERED = np.arange(256, dtype="u1")
LOWERED[0x41:0x5B] += 32
IN_WORD = np.zeros(256, dtype=bool)
IN_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def advance(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC states (not complemented) after the bytes from start to end of each word."""
    state, length = state.copy(), end - start
    which = np.flatnonzero(length <= LONG)
    for k in range(LONG):
        which = which[length[which] > k]
        if not len(which):
            break
        c = state[which]
        state[which] = CRC[(c ^ data[start[which] + k]) & np.uint32(0xFF)] ^ (c >> np.uint32(8))
    for i in np.flatnonzero(length > LONG).tolist():
        state[i] = zlib.crc32(data[start[i] : end[i]], int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


def features(offsets: np.ndarray, data: np.ndarray, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, CRC of a feature) of all words and pairs, piece by piece; document i has bytes offsets[i] to offsets[i + 1]."""
    at, upto = int(offsets[0]), int(offsets[-1])
    last_document, last_state = -1, START
    while at < upto:
        stop = min(at + piece, upto)
        while stop < upto and IN_WORD[data[stop]] and IN_WORD[data[stop - 1]]:  # not inside a word
            stop += 1
        raw = data[at:stop]
        inside, lowered = IN_WORD[raw], LOWERED[raw]
        heads = offsets[np.searchsorted(offsets, at, side="left") : np.searchsorted(offsets, stop, side="left")] - at
        change = np.empty(len(raw) + 1, dtype=bool)
        change[0], change[-1] = inside[0], inside[-1]
        np.not_equal(inside[1:], inside[:-1], out=change[1:-1])
        first, final = change[:-1] & inside, change[1:] & inside
        first[heads] = inside[heads]  # words of neighbouring documents touch
        joint = heads[heads > 0]
        final[joint - 1] = inside[joint - 1]
        start, end = np.flatnonzero(first), np.flatnonzero(final) + 1
        at = stop
        if not len(start):
            continue
        document = np.searchsorted(offsets, start + (stop - len(raw)), side="right") - 1
        state = advance(np.full(len(start), START), lowered, start, end)
        before = np.concatenate([[last_state], state[:-1]])
        paired = np.flatnonzero(document == np.concatenate([[last_document], document[:-1]]))
        space = CRC[(before[paired] ^ np.uint32(0x20)) & np.uint32(0xFF)] ^ (before[paired] >> np.uint32(8))
        pairs = advance(space, lowered, start[paired], end[paired])
        last_document, last_state = int(document[-1]), state[-1]
        yield np.concatenate([document, document[paired]]), ~np.concatenate([state, pairs])


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of an Arrow string column; null rows are empty, nothing is copied without nulls."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, "i8", len(column) + 1, column.offset * 8) if offsets is not None and len(column) else np.zeros(len(column) + 1, "i8")
    return offsets, np.frombuffer(data, "u1") if data is not None else np.empty(0, "u1")


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how often features fall in each bucket; a task gives at most a row a bucket."""

    def count(batches):
        total = np.zeros(buckets, "i8")
        for b in batches:
            for _, crc in features(*buffers(b.column(0))):
                total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], ["bucket", "n"])

    found = df.select(F.col(text_col).cast("string")).mapInArrow(count, "bucket int, n bigint")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def _vector(counts: DataFrame, buckets: int) -> np.ndarray:
    """The counts as one vector on the driver; `buckets` numbers at any size of the corpus."""
    out = np.zeros(buckets, "i8")
    for r in counts.collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the target's smoothed share over the corpus's) of each bucket."""
    s, t = raw.astype("f8"), target.astype("f8")
    return np.floor(1000 * np.log((t + 1) * (s.sum() + len(s)) / ((s + 1) * (t.sum() + len(t))))).astype("i8")


def weights(df: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_features, weight) of every document."""
    kind = df.schema[id_col].dataType

    def weigh(batches):
        for b in batches:
            offsets, data = buffers(b.column(1))
            n, total = np.zeros(len(offsets) - 1, "i8"), np.zeros(len(offsets) - 1, "i8")
            for document, crc in features(offsets, data):
                n += np.bincount(document, minlength=len(n))
                total += np.bincount(document, weights=gain[crc % np.uint32(len(gain))], minlength=len(n)).astype("i8")
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(to_arrow_type(kind)), pa.array(n), pa.array(weight)], ["id", "n_features", "weight"])

    return df.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(weigh, f"id {kind.simpleString()}, n_features bigint, weight bigint")


def gumbel(id_column: Column, seed: int = SEED) -> Column:
    """Noise in thousandths, rounded down, from the first 32 bits of the SHA-256 of `seed:id`."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_column.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS) -> DataFrame:
    """scored with rank: 1, 2, 3... for the share (percent) of eligible rows with the highest scores, else null.

    scored is stored already. n words make 2n - 1 features.
    """
    eligible = F.col("n_features") >= 2 * least_words - 1
    by = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("__tie")]
    rows = scored.filter(eligible).withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions(scored.sparkSession), *by).sortWithinPartitions(*by).drop("__tie").withColumn("at", F.monotonically_increasing_id())
    rows = staged(rows, "drawn")
    part = F.shiftright("at", 33)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # a row a task of the range exchange
    before = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"), F.floor(share * F.sum("n").over(W.partitionBy()) / 100).alias("draws"))
    placed = rows.withColumn("part", part).join(F.broadcast(before), "part")
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    columns = [F.col(c) for c in scored.columns]
    drawn = placed.select(*columns, F.when(place <= F.col("draws"), place).alias("rank"))
    return drawn.union(scored.filter(~eligible).select(*columns, F.lit(None).cast("long").alias("rank")))


def resample(df: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", buckets: int = BUCKETS, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document."""
    gain = gains(_vector(bucket_counts(df, text_col, buckets), buckets), _vector(bucket_counts(target, target_text_col, buckets), buckets))
    found = weights(df, gain, id_col, text_col)
    scored = staged(found.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "scored")
    return ranked(scored, share, least_words).withColumnRenamed("id", id_col)
