"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

A source's documents, shuffled by the MD5 of their ids, form a stream of words that may be read
PASSES times. All words to take are cut into 2 ** m blocks of equal word counts (to one word). Slot i
of the schedule maps the van der Corput point of i through the cumulative targets to a source; the
slots of a source are ranked, and its k-th slot takes the k-th block of its stream. What a document
gives is what the scheduled blocks cover of it, nothing is filled up afterwards: 2 ** m points hit
every interval to within one point, so that a source gives its target to within one block, and any
run of slots is close to the weights. A block has a 2 ** 20th of all words, BLOCK_WORDS at most while
that needs no more than 2 ** 31 slots, and one word at least.

Targets: sources in code point order (null last) weigh 5, 2, 1, repeating, and share 150 % of all
words; a target stops at PASSES times its source's words and the excess is shared again by weight.

Positions come from sums per hash bucket and then inside each bucket, so that no task holds a
source; slots find their source by equal cells of the words to take, not by a range join.

Defined cases: a null text has 0 words and takes 0, its first slot is null; a null source is a source
of its own; repeated ids are taken one by one in the order of size; whole texts are counted; an empty
table gives an empty result; only id, source and text are read, so names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from taxograph.llm.common import rows_in, staged

WEIGHTS, SHARE, PASSES = (5, 2, 1), 1.5, 2
#: The schedule has 2 ** m slots: m is SLOT_BITS while words last, more while blocks exceed BLOCK_WORDS.
SLOT_BITS, SLOT_BITS_MOST, BLOCK_WORDS = 20, 31, 2048
CELLS, CHUNK, BUCKET_ROWS = 4096, 4096, 4096


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(key, source_size, target, quota, low, high): a row per source; low to high is its part of all words to take."""
    per = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(W.orderBy("key")) - 1) % len(weights)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (place + 1).cast("int")).cast("double"))
    per = per.withColumn("most", F.col("source_size") * float(passes)).withColumn("total", F.sum("source_size").over(W.partitionBy()) * share)
    full_at = W.orderBy(F.col("most") / F.col("weight"), "key")
    rest = full_at.rowsBetween(0, W.unboundedFollowing)
    level = (F.col("total") - (F.sum("most").over(full_at.rowsBetween(W.unboundedPreceding, 0)) - F.col("most"))) / F.sum("weight").over(rest)
    per = per.withColumn("level", level).withColumn("holds", F.col("most") / F.col("weight") >= F.col("level"))
    per = per.withColumn("common", F.first(F.when(F.col("holds"), F.col("level")), ignorenulls=True).over(full_at.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    per = per.withColumn("target", F.least(F.col("most"), F.col("common") * F.col("weight")))
    per = per.withColumn("quota", F.round("target").cast("long"))
    upto = F.sum("quota").over(W.orderBy("key"))
    return per.select("key", "source_size", "target", "quota", (upto - F.col("quota")).alias("low"), upto.alias("high"))


def positions(sizes: DataFrame, rows: int) -> DataFrame:
    """sizes with bucket, rank in the bucket and offset in the source's shuffled stream."""
    digits = max(2, math.ceil(math.log(max(rows, 1) / BUCKET_ROWS + 1, 16)))
    hashed = sizes.withColumn("hash", F.md5(F.coalesce(F.col("id").cast("string"), F.lit("")))).withColumn("bucket", F.substring("hash", 1, digits))
    sums = hashed.groupBy("key", "bucket").agg(F.sum("size").alias("in_bucket"))
    starts = sums.select("key", "bucket", (F.sum("in_bucket").over(W.partitionBy("key").orderBy("bucket")) - F.col("in_bucket")).alias("bucket_start"))
    inside = W.partitionBy("key", "bucket").orderBy("hash", "id", "size").rowsBetween(W.unboundedPreceding, 0)
    ranked = hashed.withColumn("rank", F.row_number().over(inside.rowsBetween(W.unboundedPreceding, 0))).withColumn("upto", F.sum("size").over(inside))
    return ranked.join(starts, ["key", "bucket"]).withColumn("offset", F.col("bucket_start") + F.col("upto") - F.col("size")).drop("upto", "bucket_start", "hash")


def slot_bits(words: int) -> int:
    """m: the schedule of so many words has 2 ** m slots."""
    return max(min(SLOT_BITS, max(words, 1).bit_length() - 1), min(SLOT_BITS_MOST, math.ceil(math.log2(max(words, 1) / BLOCK_WORDS + 1))))


class Blocks:
    """Words cut into 2 ** bits blocks: block k begins at k * words / 2 ** bits, rounded down."""

    def __init__(self, words: int, bits: int):
        self.words, self.bits = words, bits

    def start(self, k: Column) -> Column:
        # words = whole * 2 ** bits + rest, so that no product needs more than 62 bits
        whole, rest = divmod(self.words, 1 << self.bits)
        return k * F.lit(whole).cast("long") + F.shiftright(k * F.lit(rest).cast("long"), self.bits)

    def holding(self, word: Column) -> Column:
        """The number of the block that holds a word."""
        about = F.floor(word.cast("double") * float(1 << self.bits) / float(max(self.words, 1)))
        about = F.when(self.start(about + 1) <= word, about + 1).otherwise(about)
        return F.when(self.start(about) > word, about - 1).otherwise(about)


def schedule(targets: DataFrame, blocks: Blocks) -> DataFrame:
    """(slot, key, block_no): the source of each slot and the block of its stream that it takes."""
    bits = blocks.bits
    point = F.conv(F.reverse(F.lpad(F.bin("id"), bits, "0")), 2, 10).cast("long") if bits else F.lit(0).cast("long")
    points = targets.sparkSession.range(1 << bits).select(F.col("id").alias("slot"), blocks.start(point).alias("place"))
    width = max(1, -(-blocks.words // CELLS))
    points = points.withColumn("cell", F.expr(f"place div {width}"))
    parts = targets.filter("high > low").select("key", "low", "high")
    cells = parts.withColumn("cell", F.explode(F.sequence(F.expr(f"low div {width}"), F.expr(f"(high - 1) div {width}"))))
    hit = points.join(cells, "cell").filter("place >= low and place < high").select("slot", "key", F.expr(f"slot div {CHUNK}").alias("chunk"))
    per = hit.groupBy("key", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = per.select("key", "chunk", (F.sum("n").over(W.partitionBy("key").orderBy("chunk")) - F.col("n")).alias("before"))
    ranked = hit.withColumn("r", F.row_number().over(W.partitionBy("key", "chunk").orderBy("slot")) - 1).join(before, ["key", "chunk"])
    return ranked.select("slot", "key", (F.col("before") + F.col("r")).alias("block_no"))


def _placed(df: DataFrame, id_col: str, source_col: str, text_col: str) -> tuple[DataFrame, DataFrame, Blocks]:
    """The rows with their place in their source's stream, the targets and the blocks."""
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit("t"))
    sizes = staged(df.select(F.col(id_col).alias("id"), key.alias("key"), words_of(F.col(text_col)).alias("size")), "mix-sizes")
    targets = staged(source_targets(sizes), "mix-targets", 1)
    words = targets.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    placed = positions(sizes, rows_in(sizes)).join(targets.select("key", "source_size", "target"), "key")
    return placed, targets, Blocks(words, slot_bits(words))


def _read(placed: DataFrame, targets: DataFrame, blocks: Blocks) -> DataFrame:
    """A row per document, pass and block that it has words in, with the slot that takes the block or null."""
    read = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(PASSES - 1))))
    low = F.col("offset") + F.col("pass") * F.col("source_size")
    read = read.withColumn("low", low).withColumn("high", low + F.col("size"))
    # blocks that start beyond all words to take are in no slot
    some = (F.col("size") > 0) & (F.col("low") < blocks.words)
    first, last = blocks.holding(F.col("low")), blocks.holding(F.least(F.col("high"), F.lit(blocks.words)) - 1)
    read = read.withColumn("block_no", F.explode_outer(F.when(some, F.sequence(first, last))))
    read = read.join(schedule(targets, blocks), ["key", "block_no"], "left")
    start = F.greatest(F.col("low"), blocks.start(F.col("block_no")))
    return read.withColumn("from", start - F.col("low")).withColumn("to", F.least(F.col("high"), blocks.start(F.col("block_no") + 1)) - F.col("low"))


def mixed_stream(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(slot, id, pass, from, to): the mix itself, words from to before to of each document in each slot; order by slot, from."""
    read = _read(*_placed(df, id_col, source_col, text_col)).filter("slot is not null")
    return read.select("slot", F.col("id").alias(id_col), "pass", "from", "to")


def mix(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(id, size, source_size, target, taken, first_slot) of every row: the words of it that the scheduled blocks take, and where it first comes."""
    read = _read(*_placed(df, id_col, source_col, text_col))
    taken = F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("to") - F.col("from"))), F.lit(0)).cast("long")
    out = read.groupBy("key", "bucket", "rank", "id", "size", "source_size", "target").agg(taken.alias("taken"), F.min("slot").alias("first_slot"))
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "first_slot")
