"""Quality classifier: a character n-gram model with interpolated modified Kneser-Ney smoothing.

The model is trained on every trusted text but one in HELD_OUT, which sets the thresholds. Counts of
the highest order are summed over all tasks; lower orders are continuation counts, and sums over
contexts give the discount masses: all are tables, joined by gram and never gathered. Scoring cuts the
documents into blocks of consecutive rows. A block asks once for each distinct gram and context in it,
the requests meet the count tables shard by shard, and the answers meet the block's compressed text,
which yields the perplexity of each document. Shards are as many as shuffle partitions.

A gram is ORDER code points in two columns of 21 bits a character, so that no characters share a code
and the tables grow with what is written. A document's score is its mean negative log probability per
character, with PRIOR characters of the language's held-out mean added, so that short texts are not
judged by chance. A document is rejected beyond its language's threshold: the QUANTILE of the held-out
scores plus SLACK times the distance from the median to it. A language with fewer than LEAST_HELD
held-out texts cannot tell its own spread: its threshold is that of all languages together or, if it is
larger, its own quantile plus their distance from the median; without a held-out text it is that of all.

Defined cases: a null or empty text has no perplexity and is kept; without trusted text nothing is
rejected; null languages are one language; repeated rows are scored one by one; ids are of any type
that Arrow carries; whole texts are scored; only id, language and text are read, so names cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from taxograph.llm.common import arrow_rows, by_ids, pack, partitions, rows_in, small_batches, staged, tasks_for, tidy, unpack
from taxograph.llm.wordhash import mix

ORDER, BITS, LOW, PRIOR, HELD_OUT, QUANTILE, SLACK, LEAST_HELD = 5, 21, 3, 60, 5, 0.99, 1.0, 20
BLOCK_ROWS, PIECE, STEP = 4096, 1 << 20, 1000
#: What a context keeps at least of each gram for those it was not seen with.
LEAST_DISCOUNT = 0.1
#: Grams that are looked up at once.
LOOKED_UP = 1 << 16
#: Grams that a task writes.
GRAMS_PER_TASK = 100_000
MASK = (1 << BITS) - 1
#: (kind, hi, lo): a gram of k characters has kind k; lo holds its last LOW characters, hi those before.
Keys = tuple[np.ndarray, np.ndarray]


def codes(text: str) -> np.ndarray:
    """Code points plus one; 0 stands before a text."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="u4").astype("i8") + 1


class Piece:
    """The grams of some texts, of about PIECE characters together: which distinct gram ends at each character.

    Characters are numbered inside the piece, so that a gram is one whole number there.
    """

    def __init__(self, segments: list[np.ndarray]):
        """segments: codes of consecutive characters, each after the ORDER - 1 codes before it."""
        c = np.concatenate(segments)
        seen = np.zeros(MASK + 1, dtype=bool)
        seen[c] = True
        alphabet = np.flatnonzero(seen)
        number = np.zeros(MASK + 1, dtype="u8")
        number[alphabet] = np.arange(len(alphabet))
        bits = max(1, (len(alphabet) - 1).bit_length())
        if bits * ORDER > 64:
            raise ValueError("too many characters for one number")
        local, n = number[c], len(c) - ORDER + 1
        packed = np.zeros(n, dtype="u8")
        for k in range(ORDER):
            packed = (packed << np.uint64(bits)) | local[k : k + n]
        starts = np.cumsum([0, *map(len, segments)])
        inside = np.ones(len(c), dtype=bool)
        for k in range(ORDER - 1):
            inside[starts[:-1] + k] = False
        self.sizes = np.diff(starts) - (ORDER - 1)
        self.place, found = pd.factorize(packed[inside[ORDER - 1 :]])
        part = lambda k: alphabet[((found >> np.uint64(bits * (ORDER - 1 - k))) & np.uint64((1 << bits) - 1)).astype("i8")]
        hi, lo = np.zeros(len(found), dtype="i8"), np.zeros(len(found), dtype="i8")
        for k in range(ORDER - LOW):
            hi = (hi << BITS) | part(k)
        for k in range(ORDER - LOW, ORDER):
            lo = (lo << BITS) | part(k)
        self.keys = hi, lo


def pieces(texts, size: int = 0) -> Iterator[tuple[Piece, list[int]]]:
    """(piece, text of each segment) over texts; long texts go on over several pieces."""
    size = size or PIECE
    held, owner, n = [], [], 0

    def done():
        # a piece whose characters need too many bits is halved; few characters need few bits
        alphabet = len(np.unique(np.concatenate(held)))
        if (alphabet - 1).bit_length() * ORDER <= 64:
            yield Piece(held), owner
            return
        for s, o in zip(held, owner, strict=True):
            step = 1 << (64 // ORDER - 1)
            for at in range(0, len(s) - ORDER + 1, step):
                yield Piece([s[at : at + step + ORDER - 1]]), [o]

    lead = np.zeros(ORDER - 1, dtype="i8")
    for k, t in enumerate(texts):
        if not t:
            continue
        c = np.concatenate([lead, codes(t)])
        for at in range(0, len(c) - ORDER + 1, size):
            held.append(c[at : at + size + ORDER - 1])
            owner.append(k)
            n += len(held[-1])
            if n >= size:
                yield from done()
                held, owner, n = [], [], 0
    if held:
        yield from done()


def suffix(keys: Keys, k: int) -> Keys:
    """The last k characters of grams."""
    hi, lo = keys
    return (hi & ((1 << (BITS * (k - LOW))) - 1), lo) if k > LOW else (np.zeros_like(hi), lo & ((1 << (BITS * k)) - 1))


def without_last(keys: Keys) -> Keys:
    """Grams without their last character."""
    hi, lo = keys
    return hi >> BITS, (lo >> BITS) | ((hi & MASK) << (BITS * (LOW - 1)))


def hashed(kind, keys: Keys) -> np.ndarray:
    return mix(mix(keys[0].astype("u8") ^ np.uint64(0x9E3779B97F4A7C15)) ^ keys[1].astype("u8")) ^ np.asarray(kind).astype("u8")


def distinct(keys: Keys) -> tuple[Keys, np.ndarray]:
    """The distinct grams, and the place of each gram among them."""
    h = hashed(0, keys)
    place, values = pd.factorize(h)
    first = np.empty(len(values), dtype="i8")
    first[place] = np.arange(len(h))  # any place will do
    found = keys[0][first], keys[1][first]
    if not ((found[0][place] == keys[0]) & (found[1][place] == keys[1])).all():  # different grams share a hash
        both, place = np.unique(np.stack(keys), axis=1, return_inverse=True)
        found = both[0], both[1]
    return found, place


def added_up(parts: list[tuple[Keys, np.ndarray]]) -> tuple[Keys, np.ndarray, list[np.ndarray]]:
    """The distinct grams of all parts, their summed numbers, and where the grams of each part are among them."""
    if not parts:
        return (np.empty(0, "i8"), np.empty(0, "i8")), np.empty(0, "i8"), []
    keys, place = distinct(tuple(np.concatenate(x) for x in zip(*(k for k, _ in parts), strict=True)))
    n = np.bincount(place, weights=np.concatenate([n for _, n in parts]), minlength=len(keys[0])).astype("i8")
    return keys, n, np.split(place, np.cumsum([len(n) for _, n in parts])[:-1])


class Tally:
    """Distinct grams with their numbers, added up piece by piece."""

    def __init__(self):
        self.parts: list[tuple[Keys, np.ndarray]] = []
        self.size = 0

    def add(self, texts) -> None:
        for piece, _ in pieces(texts):
            self.parts.append((piece.keys, np.bincount(piece.place, minlength=len(piece.keys[0]))))
            self.size += len(piece.keys[0])
            if self.size >= 4 * PIECE:
                self.parts = [self.whole()]
                self.size = 0

    def whole(self) -> tuple[Keys, np.ndarray]:
        return added_up(self.parts)[:2]


def gram_counts(texts: DataFrame) -> DataFrame:
    """(hi, lo, n) over all texts."""

    def run(batches):
        tally = Tally()

        def rows():
            keys, n = tally.whole()
            return pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, n)], ["hi", "lo", "n"])

        for _, (texts,) in _runs(([pa.array(np.zeros(b.num_rows, dtype="i8")), b.column(0)] for b in batches), PIECE):
            tally.add(texts)
            if len(tally.parts) == 1 and len(tally.parts[0][1]) >= 4 * PIECE:
                yield rows()
                tally = Tally()
        yield rows()

    small_batches(texts.sparkSession)
    return texts.mapInArrow(tidy(run), "hi bigint, lo bigint, n bigint").groupBy("hi", "lo").agg(F.sum("n").alias("n"))


def _suffix_columns(k: int) -> list[Column]:
    hi, lo = F.col("hi"), F.col("lo")
    if k > LOW:
        return [hi.bitwiseAND(F.lit((1 << (BITS * (k - LOW))) - 1)).alias("hi"), lo]
    return [F.lit(0).cast("long").alias("hi"), lo.bitwiseAND(F.lit((1 << (BITS * k)) - 1)).alias("lo")]


def _context_columns() -> list[Column]:
    hi, lo = F.col("hi"), F.col("lo")
    return [F.shiftright(hi, BITS).alias("hi"), F.shiftright(lo, BITS).bitwiseOR(F.shiftleft(hi.bitwiseAND(F.lit(MASK)), BITS * (LOW - 1))).alias("lo")]


class Model:
    """types: (kind, hi, lo, n) of the grams of all orders; the discounts of each order; the alphabet."""

    def __init__(self, counts: DataFrame):
        per, at = {ORDER: counts}, counts
        for k in range(ORDER - 1, 0, -1):
            at = at.select(*_suffix_columns(k)).groupBy("hi", "lo").agg(F.count(F.lit(1)).alias("n"))
            per[k] = at
        self.types = staged(reduce(DataFrame.union, [t.select(F.lit(k).alias("kind"), "hi", "lo", "n") for k, t in per.items()]), "types", tasks_for(rows_in(counts) * 2, GRAMS_PER_TASK))
        tally = {(r["kind"], r["n"]): r for r in self.types.groupBy("kind", F.least("n", F.lit(5)).alias("n")).agg(F.count(F.lit(1)).alias("grams"), F.sum(self.types["n"]).alias("sum")).collect()}  # 5 * ORDER rows at most
        self.discounts = {k: discounts({n: tally[k, n]["grams"] if (k, n) in tally else 0 for n in range(1, 5)}) for k in per}
        first = [r for (k, _), r in tally.items() if k == 1]
        self.characters = sum(r["grams"] for r in first) + 1
        self.tokens = sum(r["sum"] for r in first)
        self.first_mass = sum(self.discounts[1][min(r["n"], 3) - 1] * r["grams"] for r in first)

    def table(self) -> DataFrame:
        """(kind, hi, lo, n, total, mass): of each gram its number, and as a context the sum and the discount mass of what follows."""
        cut = F.lit(0.0)
        for k, d in self.discounts.items():
            cut = F.when(F.col("kind") == k, F.element_at(F.array(*map(F.lit, d)), F.least("n", F.lit(3)).cast("int"))).otherwise(cut)
        followed = self.types.filter("kind > 1").select((F.col("kind") - 1).alias("kind"), *_context_columns(), "n", cut.alias("cut"))
        followed = followed.groupBy("kind", "hi", "lo").agg(F.sum("n").alias("total"), F.sum("cut").alias("mass"))
        return self.types.select("kind", "hi", "lo", "n", F.lit(0).cast("long").alias("total"), F.lit(0.0).alias("mass")).union(followed.select("kind", "hi", "lo", F.lit(0).cast("long"), "total", "mass"))


def discounts(tally: dict[int, int]) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from the numbers of grams seen 1, 2, 3 and 4 times.

    Few or uneven numbers can estimate a discount of nothing or less. It is LEAST_DISCOUNT then, so that every
    context keeps mass for what it was not seen with and no text has the probability zero: one such text in a
    language's calibration would make its mean infinite and reject the whole language.
    """
    n = [tally.get(k, 0) for k in range(5)]
    y = n[1] / max(1, n[1] + 2 * n[2])
    return tuple(min(float(k), max(LEAST_DISCOUNT, k - (k + 1) * y * n[k + 1] / max(1, n[k]))) for k in (1, 2, 3))


def asked(keys: Keys) -> tuple[np.ndarray, Keys]:
    """(kind, keys): the grams and contexts that the probabilities of grams need, of each order once."""
    kinds, his, los = [], [], []
    for k in range(ORDER, 0, -1):
        wanted = [suffix(keys, k)] + ([without_last(suffix(keys, k + 1))] if k < ORDER else [])
        (hi, lo), _ = distinct(tuple(np.concatenate(x) for x in zip(*wanted, strict=True)))
        kinds.append(np.full(len(hi), k, dtype="i4")), his.append(hi), los.append(lo)
    return np.concatenate(kinds), (np.concatenate(his), np.concatenate(los))


class Answers:
    """What the count tables say about the asked grams of a block."""

    def __init__(self, kind: np.ndarray, keys: Keys, values: np.ndarray):
        self.kind, self.keys, self.values = kind, keys, values
        h = hashed(kind, keys)
        self.order = np.argsort(h, kind="stable")
        self.h = h[self.order]

    def of(self, k: int, keys: Keys) -> np.ndarray:
        """(n, total, mass) of grams of k characters, zeros where nothing is known."""
        h = hashed(k, keys)
        out = np.zeros((len(h), 3))
        left = np.searchsorted(self.h, h)
        open_ = np.arange(len(h))
        while len(open_):  # more than one round only where hashes are shared
            open_ = open_[left[open_] < len(self.h)]
            open_ = open_[self.h[left[open_]] == h[open_]]
            at = self.order[left[open_]]
            same = (self.kind[at] == k) & (self.keys[0][at] == keys[0][open_]) & (self.keys[1][at] == keys[1][open_])
            out[open_[same]] = self.values[at[same]]
            open_ = open_[~same]
            left[open_] += 1
        return out

    def log_probabilities(self, keys: Keys, base: tuple) -> np.ndarray:
        """Of each gram of ORDER characters, interpolated from the lowest order up."""
        cuts, characters, tokens, first_mass = base
        p = np.full(len(keys[0]), 1.0 / characters)
        for k in range(1, ORDER + 1):
            n = self.of(k, suffix(keys, k))[:, 0]
            if k == 1:
                total, mass = np.full(len(p), float(tokens)), np.full(len(p), first_mass)
            else:
                total, mass = self.of(k - 1, without_last(suffix(keys, k)))[:, 1:].T
            seen = np.maximum(n - np.array([0.0, *cuts[k]])[np.minimum(n, 3).astype("i8")], 0)
            p = np.where(total > 0, (seen + mass * p) / np.maximum(total, 1), p)
        return np.log(p)


def located(df: DataFrame, id_col: str, lang_col: str, text_col: str) -> DataFrame:
    """(block, id, lang, text); the block depends on file and row only, so that it is the same in every pass."""
    cols = [F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")]
    row = F.xxhash64(F.col("_metadata.file_path"), F.expr(f"_metadata.row_index div {BLOCK_ROWS}")).alias("block")
    try:
        return df.select(row, *cols)
    except AnalysisException:  # not a scan of files
        return staged(df.select(*cols), "documents").select(row, "id", "lang", "text")


def _runs(batches, size: int) -> Iterator[tuple[int, list[list]]]:
    """(block, columns) of consecutive rows of a block, split where texts get long; the text comes last."""
    block, held, n = None, [], 0
    for b in batches:
        for key, *row in zip(*(c.to_pylist() for c in getattr(b, "columns", b)), strict=True):
            if held and (key != block or n >= size):
                yield block, [list(c) for c in zip(*held, strict=True)]
                held, n = [], 0
            block = key
            held.append(row)
            n += len(row[-1] or "")
    if held:
        yield block, [list(c) for c in zip(*held, strict=True)]


def _packed(kind: np.ndarray, keys: Keys) -> tuple[bytes, bytes, bytes, np.ndarray]:
    """Grams in order of their key, packed by columns, and that order."""
    order = np.lexsort((keys[1], keys[0], kind))
    return pack(kind[order].astype("u1")), pack(np.diff(keys[0][order], prepend=0)), pack(np.diff(keys[1][order], prepend=0)), order


def _unpacked(kind: bytes, hi: bytes, lo: bytes) -> tuple[np.ndarray, Keys]:
    return unpack(kind, "u1").astype("i4"), (np.cumsum(unpack(hi, "i8")), np.cumsum(unpack(lo, "i8")))


def _requests(rows: DataFrame, shards: int) -> DataFrame:
    """(shard, block, kinds, his, los): the asked grams of each block, by shard."""

    def run(batches):
        block, tally = None, Tally()

        def done():
            kind, keys = asked(tally.whole()[0])
            shard = (hashed(kind, keys) % np.uint64(shards)).astype("i4")
            order = np.argsort(shard, kind="stable")
            cut = np.searchsorted(shard[order], np.arange(shards + 1))
            out = []
            for s in np.flatnonzero(np.diff(cut)).tolist():
                at = order[cut[s] : cut[s + 1]]
                out.append((s, block, *_packed(kind[at], (keys[0][at], keys[1][at]))[:3]))
            return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()))], ["shard", "block", "kinds", "his", "los"])

        for key, (texts,) in _runs(batches, PIECE):
            if key != block and block is not None:
                yield done()
                tally = Tally()
            block = key
            tally.add(texts)
        if block is not None:
            yield done()

    return rows.select("block", "text").mapInArrow(tidy(run), "shard int, block bigint, kinds binary, his binary, los binary")


def _answers(requests: DataFrame, table: DataFrame, shards: int) -> DataFrame:
    """(block, kinds, his, los, values): each request with what the table knows of its grams."""

    def dealt(batches):
        for b in batches:
            kind, hi, lo = (np.asarray(b.column(k)) for k in range(3))
            yield pa.RecordBatch.from_arrays([pa.array((hashed(kind, (hi, lo)) % np.uint64(shards)).astype("i4")), *b.columns], ["shard", *names])

    names, binary = ["kind", "hi", "lo", "n", "total", "mass"], ["kinds", "his", "los"]
    null = lambda names, kind: [F.lit(None).cast(kind).alias(n) for n in names]
    known = table.mapInArrow(tidy(dealt), "shard int, kind int, hi bigint, lo bigint, n bigint, total bigint, mass double")
    known = known.select("shard", F.lit(None).cast("long").alias("block"), *names, *null(binary, "binary"))
    asks = requests.select("shard", "block", *null(["kind"], "int"), *null(["hi", "lo", "n", "total"], "long"), *null(["mass"], "double"), *binary)

    def run(batches):
        shard, waiting, held = None, [], None
        for b in batches:
            at = np.asarray(b.column(0))
            cuts = np.flatnonzero(np.diff(at)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), b.num_rows], strict=True):
                if s == e:
                    continue
                if int(at[s]) != shard:
                    shard, waiting, held = int(at[s]), [], None
                part = b.slice(s, e - s)
                asking = part.column(1).is_valid()
                facts, own = part.filter(pa.compute.invert(asking)), part.filter(asking)
                if facts.num_rows:
                    waiting.append([np.asarray(facts.column(k)) for k in range(2, 8)])
                if own.num_rows:
                    if held is None:
                        held = _known(waiting)
                        waiting = []
                    out = []
                    for block, *packed in zip(*(own.column(k).to_pylist() for k in (1, 8, 9, 10)), strict=True):
                        kind, keys = _unpacked(*packed)
                        values = np.zeros((len(kind), 3))
                        for k in np.unique(kind).tolist():
                            mine = kind == k
                            values[mine] = held.of(k, (keys[0][mine], keys[1][mine]))
                        some = values.any(axis=1)  # the rest counts as zero anyway
                        values = values[some]
                        repacked = _packed(kind[some], (keys[0][some], keys[1][some]))
                        # whole numbers and short fractions of them: f4 holds the discount mass to seven digits
                        out.append((block, *repacked[:3], pack(values[repacked[3], :2].astype("u4" if values[:, :2].max(initial=0) < 1 << 32 else "u8").T), pack(values[repacked[3], 2].astype("f4"))))
                    yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64() if k == 0 else pa.binary()) for k in range(6)], ["block", *binary, "counts", "masses"])

    met = known.union(asks).repartition(shards, "shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())
    return met.mapInArrow(tidy(run), "block bigint, kinds binary, his binary, los binary, counts binary, masses binary")


def _known(rows: list[list[np.ndarray]]) -> Answers:
    """The table rows of a shard; a gram and its use as a context are rows of their own."""
    if not rows:
        rows = [[np.empty(0, t) for t in ("i4", "i8", "i8", "f8", "f8", "f8")]]
    kind, hi, lo, *values = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.lexsort((lo, hi, kind))
    kind, hi, lo, values = kind[order], hi[order], lo[order], np.stack(values, axis=1)[order].astype("f8")
    if not len(kind):
        return Answers(kind, (hi, lo), values)
    first = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])]))
    return Answers(kind[first], (hi[first], lo[first]), np.add.reduceat(values, first, axis=0))


def _squeezed(rows: DataFrame) -> DataFrame:
    """(block, ids, langs, lengths, text): documents of a block, texts together compressed."""
    kind = rows.schema["id"].dataType

    def run(batches):
        press = zstandard.ZstdCompressor(level=6)
        for block, (ids, langs, texts) in _runs(batches, PIECE * 8):
            raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
            lengths = pack(np.array([len(r) for r in raw], dtype="i8"))
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([ids], pa.list_(to_arrow_type(kind))), pa.array([langs], pa.list_(pa.string())), pa.array([lengths], pa.binary()), pa.array([press.compress(b"".join(raw))], pa.binary())], ["block", "ids", "langs", "lengths", "text"])

    return rows.mapInArrow(tidy(run), f"block bigint, ids array<{kind.simpleString()}>, langs array<string>, lengths binary, text binary")


def summed(texts: list[str], answers: Answers, base: tuple) -> np.ndarray:
    """The negative log probability of each text."""
    held = [(piece.keys, piece.place.astype("i4"), piece.sizes, owner) for piece, owner in pieces(texts)]
    keys, _, where = added_up([(k, np.zeros(len(k[0]))) for k, *_ in held])
    parts = [answers.log_probabilities(tuple(k[at : at + LOOKED_UP] for k in keys), base) for at in range(0, len(keys[0]), LOOKED_UP)]
    logp, out = np.concatenate([np.empty(0), *parts]), np.zeros(len(texts))
    for (_, place, sizes, owner), at in zip(held, where, strict=True):
        upto = np.concatenate([[0.0], np.cumsum(logp[at][place])])
        ends = np.cumsum(sizes)
        np.subtract.at(out, owner, upto[ends] - upto[ends - sizes])
    return out


def perplexities(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, lang, n, nll): characters and summed negative log probability of every document.

    trusted: (id) of the texts to train on, distinct.
    """
    spark = df.sparkSession
    small_batches(spark)
    rows = located(df, id_col, lang_col, text_col)
    counts = staged(gram_counts(by_ids(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), trusted, "id", "left_semi").select("text")), "grams", partitions(spark))
    kind = rows.schema["id"].dataType
    if not rows_in(counts):
        return rows.select("id", "lang", F.lit(0).cast("long").alias("n"), F.lit(None).cast("double").alias("nll"))
    model, shards = Model(counts), partitions(spark)
    base = model.discounts, model.characters, model.tokens, model.first_mass
    # staged for its own Arrow batches: many short rows here, few long ones below
    answers = staged(_answers(_requests(rows, shards), model.table(), shards), "answers")
    packed, whole = ["kinds", "his", "los", "counts", "masses"], ["ids", "langs", "lengths", "text"]
    texts = _squeezed(rows)
    empty = lambda names, like: [F.lit(None).cast(like.schema[n].dataType).alias(n) for n in names]
    met = answers.select("block", F.lit(0).alias("side"), *packed, *empty(whole, texts)).union(texts.select("block", F.lit(1).alias("side"), *empty(packed, answers), *whole))
    met = met.repartition(shards, "block").sortWithinPartitions("block", "side")

    def opened(pieces):
        kind, keys, counts_, masses = [], [], [], []
        for k, h, o, c, m in pieces:
            one, own = _unpacked(k, h, o)
            kind.append(one), keys.append(own), masses.append(unpack(m, "f4"))
            raw = zstandard.ZstdDecompressor().decompress(c)
            counts_.append(np.frombuffer(raw, dtype="u4" if len(raw) == 8 * len(one) else "u8").reshape(2, -1).T)
        if not kind:
            return Answers(np.empty(0, "i4"), (np.empty(0, "i8"),) * 2, np.empty((0, 3)))
        values = np.concatenate([np.concatenate(counts_).astype("f8"), np.concatenate(masses)[:, None]], axis=1)
        return Answers(np.concatenate(kind), tuple(np.concatenate(x) for x in zip(*keys, strict=True)), values)

    def run(batches):
        block, answers, pieces = None, None, []
        for b in batches:
            for key, side, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if key != block:
                    block, answers, pieces = key, None, []
                if side == 0:
                    pieces.append(row[:5])
                    continue
                if answers is None:
                    answers, pieces = opened(pieces), []
                ids, langs, lengths, text = row[5:]
                raw, ends = zstandard.ZstdDecompressor().decompress(text), np.cumsum(unpack(lengths, "i8"))
                held = [raw[start:end].decode("utf-8", "surrogatepass") for start, end in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]
                nll = [x if t else None for t, x in zip(held, summed(held, answers, base).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(ids, to_arrow_type(kind)), pa.array(langs, pa.string()), pa.array([len(t) for t in held], pa.int64()), pa.array(nll, pa.float64())], ["id", "lang", "n", "nll"])

    with arrow_rows(spark, 16):
        return staged(met.mapInArrow(tidy(run), f"id {kind.simpleString()}, lang string, n bigint, nll double"), "perplexities")


def held_out(id_column: Column) -> Column:
    return F.pmod(F.xxhash64(id_column), F.lit(HELD_OUT)) == 0


def quality(df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text", quantile: float = QUANTILE, slack: float = SLACK) -> DataFrame:
    """(id, lang, perplexity, score, threshold, kept) of every document; trusted: ids of trusted texts.

    Quantiles are of scores rounded up to a STEP-th, so that their aggregates hold no more than the steps.
    """
    ids = trusted.select(F.col(id_col).alias("id")).filter("id is not null").distinct()
    ids = staged(ids, "trusted", partitions(df.sparkSession))
    scored = perplexities(df, staged(ids.filter(~held_out(F.col("id"))), "training", partitions(df.sparkSession)), id_col, lang_col, text_col)
    scored = scored.withColumn("key", F.coalesce(F.concat(F.lit("s"), "lang"), F.lit("t")))
    calibration = scored.filter(F.col("n") > 0).join(ids.filter(held_out(F.col("id"))), "id", "left_semi")
    calibration = staged(calibration.select("key", "n", "nll"), "calibration", partitions(df.sparkSession))
    mean = calibration.rollup("key").agg((F.sum("nll") / F.sum("n")).alias("mean"), F.grouping("key").alias("all"))
    mean = staged(mean, "means", 1)
    pooled = mean.filter("all = 1").select("mean").first()
    pooled = F.lit(pooled["mean"] if pooled else None).cast("double")

    def shrunk(rows):
        held = rows.join(mean.filter("all = 0").drop("all"), "key", "left")
        return held.withColumn("score", (F.col("nll") + PRIOR * F.coalesce("mean", pooled)) / (F.col("n") + PRIOR)).drop("mean")

    low = lambda share: F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY ceil(score * {STEP}))") / STEP
    limits = shrunk(calibration).rollup("key").agg(low(quantile).alias("high"), low(0.5).alias("middle"), F.count(F.lit(1)).alias("held"), F.grouping("key").alias("all"))
    limits = staged(limits.withColumn("limit", F.col("high") + slack * (F.col("high") - F.col("middle"))), "limits", 1)
    common = limits.filter("all = 1").first()
    spread = F.lit(common["limit"] - common["middle"] if common else None).cast("double")
    common = F.lit(common["limit"] if common else None).cast("double")
    own = limits.filter("all = 0").select("key", F.when(F.col("held") >= LEAST_HELD, F.col("limit")).otherwise(F.greatest(common, F.col("high") + spread)).alias("limit"))
    out = shrunk(scored).join(own, "key", "left").withColumn("threshold", F.coalesce("limit", common))
    return out.select(F.col("id").alias(id_col), "lang", F.exp(F.col("nll") / F.col("n")).alias("perplexity"), "score", "threshold", F.coalesce(F.col("score") <= F.col("threshold"), F.lit(True)).alias("kept"))
