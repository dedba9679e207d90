"""Best-fit packing of tokenised documents into sequences, after Martello-Toth dominance reduction.

Documents become pieces of at most `capacity` tokens. Pieces of one length are interchangeable, so
all that decides a packing is how many pieces each length has: a table of `capacity` counts, however
many documents there are. On it

* reduce() fixes small sets that dominate every other set with their largest piece: j alone if nothing
  fits beside it; j with the largest k that fits, if they fill the sequence or no two pieces fit beside
  j; j with the largest a and then the largest b that fit, if no three fit beside j and no two pieces
  larger than b do. Some best packing has these sets, so the rest is a smaller instance;
* best_fit() takes the rest from the longest length down, each piece into the fullest sequence that
  has room. Equal sequences are kept as one entry with a count and filled together, so that this gives
  what piece-by-piece best fit gives in steps bounded by the capacity.

Either yields runs: "the next pieces of this length go to these sequences, q to each, from this offset
on". Pieces are ordered by length by a range exchange, numbered from counts per partition, and find
their run by binary search in a table of a few runs a length. No task or driver sees all pieces.

Tokens: a text is cut at ASCII spaces, tabs and line ends and between a Latin letter and a mark, where
the tokenizer of `vocabulary` never joins; a chunk is encoded once and kept for the worker. Special tokens' strings are what they are to the
library by default. After a document's ids comes the end id.

Defined cases: a null or empty text is one piece of the end id alone; a document longer than the
capacity is cut every `capacity` ids and nothing else is; texts are whole; ids given twice are separate
documents; ties of length are ordered by id, null first, then piece and CRC, and equal pieces are
interchangeable; an empty table gives an empty result; only id and text are read, so names cannot clash.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from taxograph.llm.common import partitions, staged

CAPACITY, END = 4096, 1
#: Chunks of at most so many characters are kept, about so many of them; longer ones are encoded anew.
KEPT_CHARS, KEPT = 64, 1_000_000
#: Where no token goes on: white space, and between a Latin letter and a mark.
CUT = re.compile(r"[ \t\r\n]+|(?<=[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u024F])(?=[.,;:!?])")


class Encoder:
    """The ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, vocabulary: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a worker a core
        self.tokenizer, self.known = Tokenizer.from_file(vocabulary), {}

    def __call__(self, text: str) -> bytes:
        chunks, known = CUT.split(text), self.known
        if new := list(set(chunks).difference(known)):
            known.update(zip(new, (np.array(e.ids, dtype="<u4").tobytes() for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)), strict=True))
        out = b"".join(map(known.__getitem__, chunks))
        if len(known) > KEPT:
            known.clear()
        else:
            for c in new:
                if len(c) > KEPT_CHARS:
                    del known[c]
        return out


@lru_cache(maxsize=1)
def encoder(vocabulary: str) -> Encoder:
    """One for all tasks of a worker."""
    return Encoder(vocabulary)


def pieces(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of the pieces of every document; ids: their token ids, too."""
    kind = df.schema[id_col].dataType
    last, step = np.array([end], dtype="<u4").tobytes(), 4 * capacity
    names = ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids

    def cut(batches):
        encode = encoder(vocabulary)
        for b in batches:
            rows: list[list] = [[] for _ in names]
            size = 0
            for i, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py()
                raw = (encode(text) if text else b"") + last
                for k, at in enumerate(range(0, len(raw), step)):
                    own = raw[at : at + step]
                    for column, value in zip(rows, (i, k, at // 4, len(own) // 4, zlib.crc32(own), own), strict=False):
                        column.append(value)
                    size += len(own) * ids
                if size > 8 << 20:
                    yield out(rows)
                    rows, size = [[] for _ in names], 0
            yield out(rows)

    def out(rows):
        types = (to_arrow_type(kind), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types, strict=False)], names)

    schema = f"id {kind.simpleString()}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * ids
    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(cut, schema)


@dataclass
class Plan:
    """Runs of pieces by length: (length, pieces, sequences' first number, pieces in each, offset)."""

    capacity: int
    sequences: int = 0
    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def open(self, count: int) -> int:
        """The first of so many new sequences."""
        self.sequences += count
        return self.sequences - count

    def put(self, length: int, pieces: int, first: int, each: int, offset: int) -> None:
        self.runs.append((length, pieces, first, each, offset))


class Lengths:
    """How many pieces each length has; the lengths that occur, in order."""

    def __init__(self, counts: np.ndarray):
        self.count = counts.tolist()
        self.used = np.flatnonzero(counts).tolist()

    def take(self, length: int, n: int) -> None:
        self.count[length] -= n
        if not self.count[length]:
            del self.used[bisect_left(self.used, length)]

    def largest(self, room: int) -> int:
        """The largest length up to room, 0 if there is none."""
        k = bisect_left(self.used, room + 1)
        return self.used[k - 1] if k else 0

    def smallest(self, n: int, above: int = 0) -> int | None:
        """The sum of the n smallest pieces longer than `above`; None if there are fewer."""
        total, k = 0, bisect_left(self.used, above + 1)
        while n and k < len(self.used):
            some = min(n, self.count[self.used[k]])
            total, n, k = total + some * self.used[k], n - some, k + 1
        return None if n else total


def dominating(j: int, left: Lengths, capacity: int) -> list[int] | None:
    """A set with j that dominates all others with j, if one of up to three pieces is found. One j is out of `left`."""
    room = capacity - j

    def fits(n, above=0):
        total = left.smallest(n, above)
        return total is not None and total <= room

    k = left.largest(room)
    if not k:
        return [j]
    if k == room or not fits(2):
        return [j, k]
    if fits(3):
        return None
    left.take(k, 1)
    b = left.largest(room - k)
    _put_back(left, k, 1)
    if not b or fits(2, above=b):
        return None
    return [j, k, b]


def _put_back(left: Lengths, length: int, n: int) -> None:
    if not left.count[length]:
        insort(left.used, length)
    left.count[length] += n


def reduce(left: Lengths, plan: Plan) -> None:
    """Fix dominating sets until a pass over all lengths finds none; equal sets are fixed together.

    That a set dominates stays true while its lengths last: taking pieces away only raises the sums of
    the smallest ones and keeps the largest one until it is used up.
    """
    again = True
    while again:
        again = False
        for j in reversed(list(left.used)):
            while left.count[j]:
                left.take(j, 1)
                found = dominating(j, left, plan.capacity)
                _put_back(left, j, 1)
                if found is None:
                    break
                again = True
                times = min(left.count[x] // found.count(x) for x in set(found))
                first, offset = plan.open(times), 0
                for x in dict.fromkeys(found):
                    left.take(x, times * found.count(x))
                    plan.put(x, times * found.count(x), first, found.count(x), offset)
                    offset += x * found.count(x)


def best_fit(left: Lengths, plan: Plan) -> None:
    """Pack what is left from the longest length down, each piece into the fullest sequence with room."""
    rooms: list[int] = []  # rooms of open sequences, in order
    open_: dict[int, list[tuple[int, int]]] = {}  # room: (first, count) of sequences

    def keep(room: int, first: int, count: int) -> None:
        if room and count:
            if room not in open_:
                insort(rooms, room)
            open_.setdefault(room, []).append((first, count))

    for length in reversed(list(left.used)):
        rest = left.count[length]
        while rest:
            k = bisect_left(rooms, length)
            if k < len(rooms):
                room = rooms[k]
                first, count = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[k]
            else:
                room = plan.capacity
                count = -(-rest // (room // length))
                first = plan.open(count)
            each = room // length
            full = min(count, rest // each)
            if full:
                plan.put(length, full * each, first, each, plan.capacity - room)
                keep(room - each * length, first, full)
                rest -= full * each
            if full < count and rest:  # one more takes the last few
                plan.put(length, rest, first + full, rest, plan.capacity - room)
                keep(room - rest * length, first + full, 1)
                full, rest = full + 1, 0
            keep(room, first + full, count - full)
        left.take(length, left.count[length])


def planned(counts: np.ndarray, capacity: int = CAPACITY) -> Plan:
    """The packing of counts[n] pieces of length n; counts has capacity + 1 entries."""
    plan, left = Plan(capacity), Lengths(counts)
    reduce(left, plan)
    best_fit(left, plan)
    return plan


def lower_bound(counts: np.ndarray, capacity: int = CAPACITY) -> int:
    """No packing has fewer sequences: the larger of all tokens over the capacity and the bound L2 of Martello and Toth."""
    lengths = np.arange(len(counts))
    upto, tokens = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * lengths)])
    most = -(-int(tokens[-1]) // capacity)
    for k in range(capacity // 2 + 1):  # pieces over capacity - k, over half, and from k to half
        alone = upto[-1] - upto[capacity - k + 1]
        half = capacity // 2 + 1
        low = min(half, capacity - k + 1)
        large, in_large = upto[capacity - k + 1] - upto[low], tokens[capacity - k + 1] - tokens[low]
        small = tokens[low] - tokens[min(k, low)]
        most = max(most, int(alone + large + max(0, -(-int(small - (large * capacity - in_large)) // capacity))))
    return most


def counted(found: DataFrame, capacity: int = CAPACITY) -> np.ndarray:
    """The number of pieces of each length, on the driver: capacity + 1 numbers at any size of the corpus."""
    out = np.zeros(capacity + 1, "i8")
    for r in found.groupBy("length").count().collect():
        out[r["length"]] = r["count"]
    return out


def placed(found: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces with sequence_id and offset."""
    spark = found.sparkSession
    plan = planned(counted(found, capacity), capacity)
    runs = np.array(sorted(plan.runs), dtype="i8").reshape(-1, 5)
    ends = np.cumsum(runs[:, 1])

    by = [F.col("length"), F.col("id").asc_nulls_first(), F.col("piece"), F.col("ids_crc32"), F.col("__tie")]
    rows = found.withColumn("__tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(partitions(spark), *by).sortWithinPartitions(*by).drop("__tie").withColumn("at", F.monotonically_increasing_id())
    rows = staged(rows, "by-length")
    part = F.shiftright("at", 33)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # a row a task of the range exchange
    before = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"))
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = rows.withColumn("part", part).join(F.broadcast(before), "part").withColumn("place", place).select("place", *found.columns)

    def seat(batches):
        for b in batches:
            place = b.column(0).to_numpy()
            run = np.searchsorted(ends, place, side="right")
            length, n, first, each, offset = runs[run].T
            at = place - (ends[run] - n)
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(first + at // each), pa.array(offset + at % each * length)], [*b.schema.names[1:], "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema.fields)
    return numbered.mapInArrow(seat, schema + ", sequence_id bigint, offset bigint")


def packed(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset) of every piece."""
    found = staged(pieces(df, vocabulary, id_col, text_col, capacity, end), "pieces")
    return placed(found, capacity).withColumnRenamed("id", id_col)


def sequences(df: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """(sequence_id, ids, starts): the token ids of every sequence and where its pieces start; a sequence is one group of bounded size."""
    found = staged(pieces(df, vocabulary, id_col, text_col, capacity, end, ids=True), "pieces-with-ids")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    out = placed(found, capacity).groupBy("sequence_id").agg(parts.alias("parts"))
    joined: Column = F.unhex(F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), ""))
    return out.select("sequence_id", joined.alias("ids"), F.transform("parts", lambda p: p["offset"]).alias("starts"))
