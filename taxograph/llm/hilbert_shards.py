"""Shards cut from a Hilbert ordering of document metadata; DataFrame functions only.

Source, language and size (power of two of its bytes) are quantised to BITS bits each. The index on
the Hilbert curve through these cells orders the documents, ties by id; runs of equal row counts are
the shards, so each covers a compact box of the metadata and its files prune on all three.

The order is made by a range exchange and a sort inside partitions, whose result is written to the
shared folder; positions come from the partitions' counts, so no task sees all rows.

Law "rows": the counts of any two shards differ by one at most.

Defined cases: null source or language sort last among their values; a null text has size 1 and the
CRC of no bytes; ties and repeated rows are ordered by id (null last), size and CRC, and equal rows
are interchangeable; an empty table gives an empty result; other columns are carried only if named
in `keep`; one that is called like a result column is refused, write_shards renames it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from taxograph.llm.common import partitions, rows_in, staged

BITS, DIMS = 5, 3
CELLS = 1 << BITS
#: Cells of at most this many distinct values of a column are broadcast, else joined by a shuffle.
BROADCAST_VALUES = 100_000
#: Result columns that come before those kept; kept columns may not have these names.
RESULT = ("size", "text_crc32", "law", "shard", "slot", "grown_shard", "curve")


def gray_tables(n: int) -> tuple[list[int], list[int], list[int]]:
    """For w below 2**n: inverse Gray code, entry corner and direction of the w-th subcube."""
    size = 1 << n
    gray = [w ^ (w >> 1) for w in range(size)]
    inverse = [gray.index(g) for g in range(size)]
    entry = [0] + [gray[2 * ((w - 1) // 2)] for w in range(1, size)]
    ones = lambda x: next(i for i in range(n + 1) if not (x >> i) & 1)  # noqa: E731  trailing ones
    direction = [0] + [ones(w - 1) % n if w % 2 == 0 else ones(w) % n for w in range(1, size)]
    return inverse, entry, direction


def hilbert_index(coordinates: list[Column], bits: int = BITS) -> Column:
    """The position along the Hilbert curve, one fold step per bit plane from the top."""
    n = len(coordinates)
    mask = (1 << n) - 1
    inverse, entry, direction = (F.array(*map(F.lit, t)) for t in gray_tables(n))

    def turned(value: Column, by: Column, left: bool) -> Column:
        """value of n bits, rotated by a number of places below n."""
        cases = [F.lit(0)] * n
        for k in range(n):
            up = k if left else (n - k) % n
            cases[k] = (F.shiftleft(value, up).bitwiseOR(F.shiftright(value, n - up))).bitwiseAND(F.lit(mask)) if up else value
        chosen = F.when(by == 0, cases[0])
        for k in range(1, n):
            chosen = chosen.when(by == k, cases[k])
        return chosen

    def step(state: Column, plane: Column) -> Column:
        w = F.element_at(inverse, turned(plane.bitwiseXOR(state["e"]), (state["d"] + 1) % n, left=False) + 1)
        return F.struct(
            (state["h"] * (1 << n) + w).cast("long").alias("h"),
            state["e"].bitwiseXOR(turned(F.element_at(entry, w + 1), (state["d"] + 1) % n, left=True)).cast("int").alias("e"),
            ((state["d"] + F.element_at(direction, w + 1) + 1) % n).cast("int").alias("d"),
        )

    planes = []
    for b in reversed(range(bits)):
        plane = F.lit(0)
        for k, c in enumerate(coordinates):
            plane = plane.bitwiseOR(F.shiftleft(F.shiftright(c.cast("int"), b).bitwiseAND(F.lit(1)), k))
        planes.append(plane)
    start = F.struct(F.lit(0).cast("long").alias("h"), F.lit(0).alias("e"), F.lit(0).alias("d"))
    return F.aggregate(F.array(*planes), start, step, lambda s: s["h"])


def _coordinate(df: DataFrame, column: str, name: str) -> DataFrame:
    """df with the quantised rank of a column among its distinct values, null last."""
    values = df.select(F.col(column).alias(f"{name}_value")).distinct()
    order = W.orderBy(F.col(f"{name}_value").asc_nulls_last())
    ranked = values.select(f"{name}_value", (F.row_number().over(order) - 1).alias("rank"), F.count(F.lit(1)).over(W.partitionBy()).alias("of"))
    cells = ranked.select(f"{name}_value", F.floor(F.col("rank") * CELLS / F.greatest(F.col("of"), F.lit(CELLS))).cast("int").alias(name))
    cells = staged(cells, "cells", 1)
    # rows with texts are not shuffled for this while the values are few
    few = rows_in(cells) <= BROADCAST_VALUES
    return df.join(F.broadcast(cells) if few else cells, df[column].eqNullSafe(cells[f"{name}_value"]), "left").drop(f"{name}_value")


def hilbert_order(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, size, text_crc32, curve, position, rows) and the kept columns; position counts from 0."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source_"), F.col(lang_col).alias("lang_"),
        (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *[F.col(k).alias(f"keep_{k}") for k in keep],
    )
    rows = _coordinate(_coordinate(rows, "source_", "x"), "lang_", "y")
    rows = rows.withColumn("z", F.least(F.length(F.bin("size")) - 1, F.lit(CELLS - 1)))
    rows = rows.withColumn("curve", hilbert_index([F.col("x"), F.col("y"), F.col("z")])).drop("source_", "lang_", "x", "y", "z")
    order = [F.col("curve"), F.col("id").asc_nulls_last(), F.col("size"), F.col("text_crc32")]
    placed = rows.repartitionByRange(partitions(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = staged(placed, "hilbert")
    part = F.shiftright(F.col("at"), 33)
    counts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(W.partitionBy()).alias("rows"))
    # a row a task of the range partitioning: without the hint the texts are shuffled again for this join
    out = placed.withColumn("part", part).join(F.broadcast(before), "part")
    return out.withColumn("position", F.col("before") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))).drop("part", "before", "at")


def hilbert_shards(df: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, curve) and the kept columns."""
    if clash := sorted({*RESULT, id_col} & {*keep}):
        raise ValueError(f"kept columns have the names of result columns: {clash}")
    ordered = hilbert_order(df, id_col, text_col, source_col, lang_col, keep)
    shard = F.expr(f"(position * {shards}) div rows")
    first = F.expr(f"(shard * rows + {shards - 1}) div {shards}")
    return ordered.withColumn("shard", shard).select(
        F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        (F.col("position") - first).cast("long").alias("slot"), F.lit(None).cast(T.IntegerType()).alias("grown_shard"), "curve", *[F.col(f"keep_{k}").alias(k) for k in keep],
    )


def write_shards(df: DataFrame, path: str, shards: int = 16, **columns) -> None:
    """Whole rows as Parquet, a folder per shard, sorted along the curve for file pruning.

    Tasks take ranges of (shard, slot), so a shard is written by as many as its rows need. Columns
    called like a result column get an underscore in front.
    """
    rest = [c for c in df.columns if c != columns.get("id_col", "doc_id")]
    named = {c: "_" + c if c in RESULT else c for c in rest}
    roles = {k: named.get(v, v) for k, v in ({"text_col": "text", "source_col": "source", "lang_col": "lang"} | columns).items()}
    out = hilbert_shards(df.withColumnsRenamed(named), shards, keep=tuple(named.values()), **roles)
    tasks = max(shards, partitions(df.sparkSession))
    out.repartitionByRange(tasks, "shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
