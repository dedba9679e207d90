"""Benchmark decontamination over a stored positional inverted index of the training words.

The index is cut by documents: a row holds the postings of some documents of together about
BLOCK_BYTES of text, as terms sorted by hash, their counts and their positions; rows are written to
the shared folder. Positions count words from the first document on, with one place left free
between documents, so that no phrase crosses. A phrase search takes, per row, the rarest of its
terms, shifts that posting list by the term's place in the phrase and intersects with the shifted
lists of the next rarer terms, all phrases of a pass at once. A proximity search asks for all terms
inside a span. The benchmark goes to the tasks in passes of at most PASS_BYTES of text.

Terms are found by 64-bit hashes and confirmed by their bytes, so that different words never meet.

Defined cases: a null text has no words, an item without words has no window and hits nothing; a
null item id hits but is not listed; repeated documents and ids are judged one by one; items with
one id count once; whole texts of any length are indexed; document ids are whole numbers, other types
are refused; only id and text columns are read, so names cannot clash; an empty table on either side
gives no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxograph.llm.common import arrow_rows, pack, planes, small_batches, staged, tidy, unpack, unplanes, whole_id
from taxograph.llm.wordhash import ALNUM, Distinct, Words, matched

WINDOW, BLOCK_BYTES, PASS_BYTES, CANDIDATES = 13, 4 << 20, 16 << 20, 1 << 21
INDEX = "docs binary, doc_words binary, doc_null binary, terms binary, counts binary, positions binary"
HITS = "block bigint, place int, id bigint, n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"


def blocks(batches, least: int = BLOCK_BYTES) -> Iterator[tuple[list, list]]:
    """(ids, texts) of consecutive rows with about `least` characters together."""
    ids, texts, size = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            ids.append(i), texts.append(t)
            size += len(t or "") + 16
            if size >= least:
                yield ids, texts
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


def build_index(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index rows of df, numbered by `block` and stored in the shared folder. Ids are whole numbers."""
    small_batches(df.sparkSession)

    def build(batches):
        for ids, texts in blocks(batches):
            words = Words(texts, ALNUM)
            distinct = Distinct(words)
            position = np.arange(len(distinct.number), dtype="u4") + np.repeat(np.arange(len(ids), dtype="u4"), words.counts)
            position = position[np.argsort(distinct.number, kind="stable")]
            columns = [
                pack(np.array([0 if i is None else i for i in ids], dtype="i8")), pack(words.counts.astype("u4")), pack(np.array([i is None for i in ids], dtype="u1")),
                pack(np.frombuffer(b" ".join(distinct.strings), dtype="u1")), planes(np.bincount(distinct.number, minlength=len(distinct.strings)).astype("u4")), planes(np.diff(position.astype("i4"), prepend=np.int32(0))),
            ]
            yield pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], [c.split()[0] for c in INDEX.split(", ")])

    rows = df.select(whole_id(df, id_col), F.col(text_col)).mapInArrow(tidy(build), INDEX)
    return staged(rows.withColumn("block", F.monotonically_increasing_id()), "postings")


class Postings:
    """One index row, opened."""

    def __init__(self, docs: bytes, doc_words: bytes, doc_null: bytes, terms: bytes, counts: bytes, positions: bytes):
        self.docs, self.words, self.null = unpack(docs, "i8"), unpack(doc_words, "u4").astype("i8"), unpack(doc_null, "u1").astype(bool)
        held = Words([unpack(terms, "u1").tobytes()], ALNUM)
        self.terms, self.counts = held.hashes(), unplanes(counts, "u4").astype("i8")
        self.strings = [held.word(i) for i in range(len(self.terms))]
        self.at = np.cumsum(unplanes(positions, "i4"), dtype="i8")
        self.first = np.cumsum(self.counts) - self.counts
        #: Term rank and position in one number, ascending.
        self.keys = (np.repeat(np.arange(len(self.terms), dtype="i8"), self.counts) << 32) | self.at
        self.doc_start = np.cumsum(self.words + 1) - (self.words + 1)

    def ranks(self, windows: Windows) -> np.ndarray:
        """The rank of each term of the windows here, -1 where it does not occur."""
        return matched(windows.vocabulary, windows.strings, self.terms, self.strings)

    def has(self, rank: np.ndarray, position: np.ndarray) -> np.ndarray:
        key = (rank << 32) | position
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return (position >= 0) & (self.keys[at] == key)

    def list_of(self, rank: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(owner, position) of every posting of the ranks, each for its owner."""
        n = self.counts[rank]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(owner, n), self.at[np.repeat(self.first[rank], n) + inner]

    def phrases(self, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
        """(window, first position) of every exact occurrence."""
        rank = self.ranks(windows)[windows.term]
        used = np.arange(windows.term.shape[1]) < windows.length[:, None]
        alive = np.flatnonzero(((rank >= 0) | ~used).all(axis=1) & (windows.length > 0))
        if not len(alive):
            return np.empty(0, "i8"), np.empty(0, "i8")
        frequency = np.where(used[alive], self.counts[np.maximum(rank[alive], 0)], np.iinfo("i8").max)
        rarest = np.argsort(frequency, axis=1, kind="stable")
        found = [(np.empty(0, "i8"), np.empty(0, "i8"))]
        cuts = np.cumsum(np.minimum(frequency[np.arange(len(alive)), rarest[:, 0]], 1 << 40)) // CANDIDATES
        for part in np.split(np.arange(len(alive)), np.flatnonzero(np.diff(cuts)) + 1):
            place = rarest[part, 0]
            who, start = self.list_of(rank[alive[part], place], part)
            start = start - rarest[who, 0]
            for k in range(1, windows.term.shape[1]):
                place = rarest[who, k]
                w = alive[who]
                keep = ~used[w, place] | self.has(rank[w, place], start + place)
                who, start = who[keep], start[keep]
                if not len(who):
                    break
            ok = start >= 0
            found.append((alive[who[ok]], start[ok]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def proximities(self, windows: Windows, slack: int) -> tuple[np.ndarray, np.ndarray]:
        """(window, first position) of spans of length + slack words that hold all its terms, in any order."""
        rank = self.ranks(windows)[windows.term]
        used = np.arange(windows.term.shape[1]) < windows.length[:, None]
        alive = np.flatnonzero(((rank >= 0) | ~used).all(axis=1) & (windows.length > 0))
        if not len(alive):
            return np.empty(0, "i8"), np.empty(0, "i8")
        frequency = np.where(used[alive], self.counts[np.maximum(rank[alive], 0)], np.iinfo("i8").max)
        found = [(np.empty(0, "i8"), np.empty(0, "i8"))]
        for k, w in enumerate(alive):
            span = int(windows.length[w]) + slack
            anchor = rank[w, frequency[k].argmin()]
            starts = np.unique((self.at[self.first[anchor] : self.first[anchor] + self.counts[anchor]][:, None] - np.arange(span)).ravel())
            starts = starts[starts >= 0]
            doc = np.searchsorted(self.doc_start, starts, side="right") - 1
            starts = starts[starts < self.doc_start[doc] + self.words[doc]]
            last = np.minimum(starts + span, (self.doc_start + self.words)[np.searchsorted(self.doc_start, starts, side="right") - 1])
            for r in {int(x) for x in rank[w, : windows.length[w]]}:
                own = self.at[self.first[r] : self.first[r] + self.counts[r]]
                near = np.searchsorted(own, starts)
                keep = (near < len(own)) & (own[np.minimum(near, len(own) - 1)] < last)
                starts, last = starts[keep], last[keep]
            found.append((np.full(len(starts), w), starts))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def documents(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(document, place in it) of positions."""
        doc = np.searchsorted(self.doc_start, position, side="right") - 1
        return doc, position - self.doc_start[doc]


class Windows:
    """The windows of some benchmark items: terms as numbers of a vocabulary, padded with 0."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        held = Words([t for _, t in items], ALNUM)
        distinct, words = Distinct(held), held.counts
        self.vocabulary, self.strings, number = distinct.terms, distinct.strings, distinct.number
        starts = np.cumsum(words) - words
        item, first, length = [np.empty(0, "i8")], [np.empty(0, "i8")], [np.empty(0, "i8")]
        for k, (s, n) in enumerate(zip(starts.tolist(), words.tolist(), strict=True)):
            if n:
                count = max(1, n - window + 1)
                item.append(np.full(count, k)), first.append(s + np.arange(count)), length.append(np.full(count, min(n, window)))
        self.item, first, self.length = np.concatenate(item), np.concatenate(first), np.concatenate(length)
        width = np.arange(window)
        if not len(number):
            self.vocabulary, self.strings, number = np.zeros(1, "u8"), [b""], np.zeros(1, "i8")
        self.term = np.where(width < self.length[:, None], number[np.minimum(first[:, None] + width, len(number) - 1)], 0)
        self.ids = [i for i, _ in items]


def passes(benchmark: DataFrame, id_col: str, text_col: str, most: int = PASS_BYTES) -> Iterator[list[tuple]]:
    """The benchmark in parts whose text is bounded, one at a time on the driver."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = -(-size // most) or 1
    for p in range(parts):
        one = items if parts == 1 else items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(parts)) == p)
        yield [(r["id"], r["text"]) for r in one.toLocalIterator()]


def hits(index: DataFrame, benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, slack: int | None = None) -> DataFrame:
    """(block, place, id, n_words, starts, ends, items) of every document: united spans of hit words, items hit.

    slack None: exact phrases; else spans of window + slack words with all the window's words.
    """
    spark = index.sparkSession
    parts = [*_search_all(index, benchmark, id_col, text_col, window, slack)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if len(parts) > 1:
        out = out.groupBy("block", "place", "id", "n_words").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("starts", "ends", "items")])
    small_batches(spark)
    return out


def united(doc: np.ndarray, start: np.ndarray, end: np.ndarray, doc_start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end) of the unions of overlapping or touching spans, which come ordered by document and start."""
    if not len(doc):
        return doc, start, end
    offset = doc_start[doc]
    upto = np.maximum.accumulate(end + offset)
    first = np.flatnonzero(np.concatenate([[True], (start + offset)[1:] > upto[:-1]]))
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], start[first], upto[last] - offset[first]


def _search_all(index, benchmark, id_col, text_col, window, slack):
    for items in passes(benchmark, id_col, text_col):
        wanted = Windows(items, window)

        def search(batches, wanted=wanted):
            for b in batches:
                for *row, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    postings = Postings(*row)
                    who, at = postings.phrases(wanted) if slack is None else postings.proximities(wanted, slack)
                    length = wanted.length[who] + (slack or 0)
                    doc, place = postings.documents(at)
                    order = np.lexsort((place, doc))
                    doc, place, length, who = doc[order], place[order], length[order], who[order]
                    span_doc, span_start, span_end = united(doc, place, np.minimum(place + length, postings.words[doc]), postings.doc_start)
                    cut, span_cut = (np.searchsorted(x, np.arange(len(postings.docs) + 1)) for x in (doc, span_doc))
                    starts, ends, listed = [], [], []
                    for k in range(len(postings.docs)):
                        starts.append(span_start[span_cut[k] : span_cut[k + 1]]), ends.append(span_end[span_cut[k] : span_cut[k + 1]])
                        found = np.unique(wanted.item[who[cut[k] : cut[k + 1]]]).tolist()
                        listed.append(sorted({wanted.ids[i] for i in found} - {None}))
                    ids = pa.array([None if gone else i for i, gone in zip(postings.docs.tolist(), postings.null.tolist(), strict=True)], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block] * len(starts)), pa.array(range(len(starts)), pa.int32()), ids, pa.array(postings.words), pa.array(starts, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64())), pa.array(listed, pa.list_(pa.string()))],
                        ["block", "place", "id", "n_words", "starts", "ends", "items"],
                    )

        with arrow_rows(index.sparkSession, 8):
            yield staged(index.mapInArrow(tidy(search), HITS), "phrase-hits")


def contamination(df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, one_in: int = 20) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, contaminated) of every document.

    contaminated: some word is hit, and at least one word in `one_in`.
    """
    found = hits(build_index(df, id_col, text_col), benchmark, item_id_col, item_text_col, window)
    # spans come in the order of their starts only within a pass
    spans = F.array_sort(F.arrays_zip("starts", "ends"))

    def add(state, span):
        new = F.greatest(F.lit(0).cast("long"), span["ends"] - F.greatest(span["starts"], state["upto"]))
        return F.struct((state["hit"] + new).alias("hit"), F.greatest(state["upto"], span["ends"]).alias("upto"))

    zero = F.lit(0).cast("long")
    n_hit = F.aggregate(spans, F.struct(zero.alias("hit"), zero.alias("upto")), add, lambda s: s["hit"])
    out = found.select(F.col("id").alias(id_col), "n_words", n_hit.alias("n_hit"), F.array_sort(F.array_distinct("items")).alias("items"))
    return out.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items", ((F.col("n_hit") > 0) & (one_in * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
