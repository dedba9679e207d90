"""Near-duplicate detection by a chosen-path set similarity join over minwise tokens.

A document's set holds its distinct 5-word shingles. Equal sets are one class first. In each of TREES
independent trees a class goes to the node of its first minwise token. A node of at most SMALL classes
is compared exhaustively; the members of a larger one meet PIVOTS common partners first. Nodes whose
members are one component then are done. Of the others, those of at most WHOLE members are compared
exhaustively, without the pairs inside a component. Larger ones are compared exhaustively too, in
blocks of about PART by PART members over many tasks, all members outside the node's main component
against all of its members, where this moves fewer rows than branching. The others branch: each member
goes to BRANCH children by as many further tokens, until nodes are small enough, in one component, or
DEPTH levels deep; what is still large then is compared in blocks. In these larger groups likely pairs are confirmed where they are found, a pair is skipped once its
ends are connected, and only the links of a spanning forest leave the task.

A pair of similarity 0.75 shares a first-level node of a tree with probability 0.75 and each further
one with 1 - 0.25 ** BRANCH, so that all 16 trees miss it with probability 2e-10 when its nodes are
small and 2e-7 when they are split down to the last level.

Compared pairs pass when 2-bit sketches of SKETCH minwise tokens agree in LIKELY places at least
(below that, a pair of similarity 0.75 is lost with probability under 1e-6) and are then confirmed
on the full sets, word by word: each class with its likeliest partner first, then every pair whose
ends are not yet connected. Links inside a component cannot change it and are left out.

Defined cases: null texts and texts without words have an empty set, link with nothing and are kept;
shorter texts than five words are one shingle; whole texts are used; rows of one id are one document
for linking (any of its texts may link); a null id has no component and is not kept; ids are whole
numbers, other types are refused; an empty table gives an empty result; only id and text are read, so
names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxograph.llm.common import arrow_rows, by_ids, partitions, rows_in, small_batches, staged, tasks_for, tidy, whole_id
from taxograph.llm.components import components, stars
from taxograph.llm.decontaminate import blocks
from taxograph.llm.wordhash import VISIBLE, Distinct, Words, mix

#: A block has two sides of PART members, a node compared whole as many in all. Branching down to DEPTH makes
#: up to 2 + 4 + 8 rows a member; a node is compared in blocks at once where that makes at most EACH.
WORDS, TREES, BRANCH, DEPTH, SMALL, PIVOTS, PART, EACH = 5, 16, 2, 4, 64, 4, 2048, 8
WHOLE = 2 * PART
SKETCH, LIKELY, SEED = 128, 82, 7
SIMILAR = (75, 100)
#: Rows of the first level that a task writes; bytes of text that are confirmed together; ids of a bucket of pairs.
#: Pairs that wait before they are confirmed.
ROWS_PER_TASK, TOGETHER, BUCKET, PENDING = 100_000, 4 << 20, 1024, 1 << 20

_RNG = np.random.default_rng(SEED)
FACTORS = (_RNG.integers(0, 1 << 32, SKETCH, dtype="u8") | 1).astype("u4")[:, None]
OFFSETS = _RNG.integers(0, 1 << 32, SKETCH, dtype="u8").astype("u4")[:, None]
TURNS = [*map(int, _RNG.integers(0, 1 << 62, PIVOTS))]
S = [f"s{k}" for k in range(SKETCH // 32)]
#: The tokens of a tree by level from the second on.
NEXT = [f"t{level}_{b}" for level in range(2, DEPTH + 1) for b in range(BRANCH)]
FURTHER = TREES * len(NEXT)


def shingles(words: Words, seed: int = 0, size: int = WORDS) -> list[np.ndarray]:
    """The shingle hashes of each text, in order; a shorter text is one shingle."""
    hashes, counts = words.hashes(seed), words.counts
    n = max(0, len(hashes) - size + 1)
    rolled = np.full(n, size, dtype="u8")
    for k in range(size):
        rolled = mix(rolled ^ hashes[k : k + n])
    out = []
    for s, c in zip((np.cumsum(counts) - counts).tolist(), counts.tolist(), strict=True):
        if 0 < c < size:
            short = np.array([c], dtype="u8")
            for h in hashes[s : s + c]:
                short = mix(short ^ h)
            out.append(short)
        else:
            out.append(rolled[s : s + max(0, c - size + 1)])
    return out


def exact_sets(texts: list[bytes], size: int = WORDS) -> list[np.ndarray]:
    """The sorted distinct shingles of each text as numbers; equal numbers are equal words, byte by byte."""
    words = Words(texts, VISIBLE)
    number, counts = Distinct(words).number + 1, words.counts
    starts, ends = np.cumsum(counts) - counts, np.cumsum(counts)
    number = np.concatenate([number, np.zeros(size, dtype="i8")])
    owner = np.repeat(np.arange(len(texts)), counts)
    at = np.arange(len(owner))
    reach = ends[owner] - at
    long = np.where(reach >= size, True, (at == starts[owner]))
    code = np.zeros(len(owner), dtype="i8")
    for k in range(size):  # pairs of numbers become numbers again, so that nothing is merged
        code = np.unique(code * (int(number.max(initial=0)) + 1) + np.where(k < reach, number[at + k], 0), return_inverse=True)[1]
    return [np.unique(code[s:e][long[s:e]]) for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]


def minwise(tokens: np.ndarray) -> np.ndarray:
    """The minwise token of a set under each of the hash functions."""
    h, least = (tokens >> np.uint64(32)).astype("u4"), np.full(SKETCH, (1 << 32) - 1, dtype="u4")
    step = (1 << 18) // SKETCH
    for at in range(0, len(h), step):
        least = np.minimum(least, (h[None, at : at + step] * FACTORS + OFFSETS).min(axis=1))
    return least


def sketch(tokens: np.ndarray) -> bytes:
    """Two bits of each token."""
    bits = np.stack([tokens & 1, (tokens >> 1) & 1], axis=1).astype("u1")
    return np.packbits(bits.ravel()).tobytes()


SIGNED = "id bigint, n_shingles bigint, d0 bigint, d1 bigint, first array<int>, further binary, " + ", ".join(f"{s} bigint" for s in S)


def signatures(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: set size, digest of the set, minwise tokens and sketch."""
    small_batches(df.sparkSession)

    def run(batches):
        for ids, texts in blocks(batches, 1 << 20):
            words = Words(texts, VISIBLE)
            n, digests, first, further, sketches = [], [], [], [], []
            for own, other in zip(shingles(words), shingles(words, 1), strict=True):
                held, at = np.unique(own, return_index=True)
                n.append(len(held))
                digests.append(blake2b(held.tobytes() + mix(other[at]).sum(dtype="u8").tobytes(), digest_size=16).digest())
                tokens = minwise(held)
                first.append(tokens[:TREES].view("i4"))
                further.append((tokens[TREES : TREES + FURTHER] & 0xFFFF).astype("<u2").tobytes())
                sketches.append(sketch(tokens))
            longs = [np.frombuffer(b"".join(x), dtype="<i8").reshape(len(ids), -1) for x in (digests, sketches)]
            whole = [pa.array(np.ascontiguousarray(c)) for x in longs for c in x.T]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), *whole[:2], pa.array(first, pa.list_(pa.int32())), pa.array(further, pa.binary()), *whole[2:]], [c.split()[0] for c in SIGNED.split(", ")])

    return staged(df.select(whole_id(df, id_col), F.col(text_col)).mapInArrow(tidy(run), SIGNED), "signatures")


def likely(a: np.ndarray, b: np.ndarray, least: int = LIKELY) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of a, row of b, agreeing tokens) of all pairs of sketches that agree in `least` places, some rows of a at a time."""
    step = max(1, (1 << 18) // max(1, len(b)))
    for at in range(0, len(a), step):
        differ = np.zeros((len(a[at : at + step]), len(b)), dtype="u1")
        for k in range(a.shape[1]):
            x = a[at : at + step, k, None] ^ b[None, :, k]
            differ += np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(0x5555555555555555))
        i, j = np.nonzero(differ <= SKETCH - least)
        yield i + at, j, SKETCH - differ[i, j].astype("i8")


def grouped(rows: DataFrame, keys: list[str], compare, schema: str) -> DataFrame:
    """The rows that compare(columns by name) makes of each group of rows; groups are bounded.

    The groups of a task come one after another; each is held alone.
    """
    names = [*keys, *(c for c in rows.columns if c not in keys)]
    out = [c.split()[0] for c in schema.split(", ")]

    def run(batches):
        mark, held = None, []

        def done():
            found = compare({c: np.concatenate([h[c] for h in held]) for c in names})
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], out)

        for batch in batches:
            columns = {c: batch.column(k).to_numpy(zero_copy_only=False) for k, c in enumerate(names)}
            same = [columns[k][1:] == columns[k][:-1] for k in keys]
            cuts = np.flatnonzero(~reduce(np.logical_and, same)) + 1
            for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if s == e:
                    continue
                now = tuple(columns[k][s] for k in keys)
                if held and now != mark:
                    yield done()
                    held = []
                mark = now
                held.append({c: v[s:e] for c, v in columns.items()})
        if held:
            yield done()

    return rows.select(names).repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(tidy(run), schema)


PAIRS, LINKS = "a bigint, b bigint, agree bigint", "a bigint, b bigint"


def _sketches(g: dict[str, np.ndarray], at=slice(None)) -> np.ndarray:
    return np.stack([g[s][at] for s in S], axis=1).view("u8")


def _exhaustive(g: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The likely pairs of a small node."""
    x = _sketches(g)
    i, j, agree = (np.concatenate(v) for v in zip(*likely(x, x), strict=True))
    apart = (i < j) & (g["id"][i] != g["id"][j])
    a, b = g["id"][i[apart]], g["id"][j[apart]]
    return np.minimum(a, b), np.maximum(a, b), agree[apart]


def _confirm(g: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, label: np.ndarray, sets: list[np.ndarray] | None, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(vertex, root, label): what confirmed ones of the pairs of rows (i, j) connect, and the labels after it.

    sets: those of all rows, if they are held; else texts are read for some of the pairs at a time.
    """
    part, whole = similar
    needed = np.unique(np.concatenate([i, j]))
    block = np.zeros(len(label), dtype="i8")
    if sets is None:
        block[needed] = np.cumsum([zstandard.frame_content_size(t) for t in g["text"][needed]]) // TOGETHER
    order = np.lexsort((j, i, block[j], block[i]))
    i, j = i[order], j[order]
    cuts = np.flatnonzero((np.diff(block[i]) != 0) | (np.diff(block[j]) != 0)) + 1
    links_ = [(np.empty(0, "i8"),) * 2]
    for x, y in zip(np.split(i, cuts), np.split(j, cuts), strict=True):
        apart = label[x] != label[y]
        x, y = x[apart], y[apart]
        if not len(x):
            continue
        own, a, b = sets, x, y
        if sets is None:
            at, places = np.unique(np.concatenate([x, y]), return_inverse=True)
            own, a, b = exact_sets(plain(g["text"][at])), places[: len(x)], places[len(x) :]
        n = np.array([len(s) for s in own])
        both = shared_counts(a, b, own)
        ok = (both > 0) & (whole * both >= part * (n[a] + n[b] - both))
        vertex, root = stars(label[x[ok]], label[y[ok]])
        if len(vertex):
            links_.append((vertex, root))
            order = np.argsort(vertex)
            k = np.minimum(np.searchsorted(vertex[order], label), len(vertex) - 1)
            label = np.where(vertex[order][k] == label, root[order][k], label)
    return *(np.concatenate(v) for v in zip(*links_, strict=True)), label


def plain(texts) -> list[bytes]:
    opener = zstandard.ZstdDecompressor()
    return [opener.decompress(t) for t in texts]


def _forest(g: dict[str, np.ndarray], left: np.ndarray, right: np.ndarray | None, similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the components of left and right rows (or of left rows among each other) which confirmed pairs connect.

    Texts are opened only for likely pairs whose ends are still apart.
    """
    label, links_, held, pending, sets = g["label"], [(np.empty(0, "i8"),) * 2], [], 0, None
    other = left if right is None else right
    size = sum(zstandard.frame_content_size(t) for t in g["text"])
    sketches = _sketches(g)

    def confirm():
        nonlocal label, sets
        i, j = (np.concatenate(v) for v in zip(*held, strict=True))
        if sets is None and size <= 4 * TOGETHER and len(i) >= len(label):
            sets = exact_sets(plain(g["text"]))
        *found, label = _confirm(g, i, j, label, sets, similar)
        links_.append(tuple(found))

    for i, j, _ in likely(sketches[left], sketches[other]):
        i, j = left[i], other[j]
        apart = (label[i] != label[j]) if right is not None else (label[i] != label[j]) & (i < j)
        if apart.any():
            held.append((i[apart], j[apart]))
            pending += len(held[-1][0])
        if pending >= PENDING:
            confirm()
            held, pending = [], 0
    if held:
        confirm()
    return tuple(np.concatenate(v) for v in zip(*links_, strict=True))


def _within(g: dict[str, np.ndarray], similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    return _forest(g, np.arange(len(g["id"])), None, similar)


def _across(g: dict[str, np.ndarray], similar: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    return _forest(g, *(np.flatnonzero(g["side"] == k) for k in (0, 1)), similar)


def _best(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.max("agree").alias("agree"))


def agreeing(own: list[Column], other: list[Column]) -> Column:
    """How many two-bit tokens agree between two sketches, 32 tokens to a column."""

    def differing(x: Column, y: Column) -> Column:
        z = x.bitwiseXOR(y)
        return F.bit_count(z.bitwiseOR(F.shiftrightunsigned(z, 1)).bitwiseAND(F.lit(0x5555555555555555)))

    return F.lit(SKETCH) - reduce(lambda a, b: a + b, map(differing, own, other))


def first_level(classes: DataFrame, tasks: int) -> tuple[DataFrame, bool]:
    """(node, n, tree, id, sketch) of the classes in nodes of several members, and whether a node is large."""
    keys = classes.select(F.posexplode("first").alias("tree", "token"), "id").select(F.xxhash64("tree", "token").alias("node"), "tree", "id")
    nodes = keys.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("x"), F.max("id").alias("y")).filter("x <> y")
    nodes = staged(nodes.select("node", "n"), "nodes", tasks)
    members = keys.join(nodes, "node").join(classes.select("id", *S), "id")
    members = staged(members.select("node", "n", "tree", "id", F.col("id").alias("label"), *S), "members", tasks)
    return members, not nodes.filter(F.col("n") > SMALL).isEmpty()


def starred(large: DataFrame) -> DataFrame:
    """(a, b, agree): the likely pairs of members of large nodes with the pivots of their node.

    Pivots come from PIVOTS orders common to all nodes, so that trees which hold the same large group
    link it to the same few pivots.
    """
    turned = [F.col("id").bitwiseXOR(F.lit(t)) for t in TURNS]
    least = large.groupBy("node").agg(*[F.min(t).alias(f"p{k}") for k, t in enumerate(turned)])
    chosen = least.select("node", F.explode(F.array(*[F.col(f"p{k}").bitwiseXOR(F.lit(t)) for k, t in enumerate(TURNS)])).alias("id")).distinct()
    pivots = large.select("node", "id", *S).join(chosen, ["node", "id"]).dropDuplicates(["node", "id"])
    # one row per node with its few pivots, so that a member is joined once
    pivots = pivots.groupBy("node").agg(F.collect_list(F.struct("id", *S)).alias("pivots"))
    agree = lambda p: agreeing([F.col(s) for s in S], [p[s] for s in S]).cast("long")
    met = large.select("node", "id", *S).join(pivots, "node")
    near = F.filter(F.transform("pivots", lambda p: F.struct(p["id"].alias("other"), agree(p).alias("agree"))), lambda x: (x["agree"] >= LIKELY) & (x["other"] != F.col("id")))
    met = met.select("id", F.explode(near).alias("x")).select("id", "x.other", "x.agree")
    return met.select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"), "agree")


def measured(rows: DataFrame) -> DataFrame:
    """(node, n, main, parts, rests) of the nodes whose members (node, label) are of several components.

    main is the label of the most; all members make `parts` sides of a block of about PART, those
    outside main `rests`.
    """
    sizes = rows.groupBy("node", "label").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.groupBy("node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("most")).filter("n > most.n")
    return sizes.select("node", "n", F.col("most.label").alias("main"), F.expr(f"n div {PART} + 1").alias("parts"), F.expr(f"(n - most.n) div {PART} + 1").alias("rests"), F.expr(f"(n - most.n) * (n div {PART} + 1) + n * ((n - most.n) div {PART} + 1) <= {EACH} * n").alias("cheap"))


def further_levels(df: DataFrame, large: DataFrame, known: DataFrame, classes: DataFrame, id_col: str, text_col: str, tasks: int, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """Links (a, b) between components that connect what is still apart among the members of large nodes."""
    named = large.select("node", "tree", "id", *S).join(known.withColumnRenamed("component", "label"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    width = 2 * len(NEXT)

    def token(k: int) -> Column:
        return F.expr(f"substring(further, tree * {width} + {2 * k + 1}, 2)").alias(NEXT[k])

    rows = named.join(staged(measured(named), "nodes", tasks), "node").join(classes.select("id", "further"), "id")
    rows = staged(rows.select("node", "n", "main", "parts", "rests", "cheap", "id", "label", *S, *map(token, range(len(NEXT)))), "open", tasks)
    if not rows_in(rows):
        return rows.select(F.col("id").alias("a"), F.col("label").alias("b"))
    texts = squeezed_texts(df, staged(rows.select("id").distinct(), "open-ids", tasks), id_col, text_col)
    found, level = [], 1
    while True:
        at_once = F.col("cheap") if level < DEPTH else F.lit(True)
        whole = rows.filter(F.col("n") <= WHOLE).select("node", "id", "label", *S).join(texts, "id")
        found.append(grouped(whole, ["node"], lambda g: _within(g, similar), LINKS))
        rows = rows.filter(F.col("n") > WHOLE)
        if rows.isEmpty():
            break
        found.append(in_blocks(rows.filter(at_once), texts, similar))
        rows = rows.filter(~at_once)
        if level == DEPTH or rows.isEmpty():
            break
        now, later = NEXT[BRANCH * (level - 1) : BRANCH * level], NEXT[BRANCH * level :]
        kids = rows.select(F.explode(F.array(*[F.xxhash64("node", F.lit(b), t) for b, t in enumerate(now)])).alias("node"), "id", "label", *S, *later)
        rows = staged(kids.join(staged(measured(kids), "nodes", tasks), "node"), "open", tasks)
        level += 1
    with arrow_rows(df.sparkSession, 256):
        return staged(reduce(DataFrame.union, found).distinct(), "apart", tasks)


def in_blocks(held: DataFrame, texts: DataFrame, similar: tuple[int, int]) -> DataFrame:
    """Links (a, b): what is outside the main component of a node against all its members, block by block."""
    spread = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
    dealt = lambda n: F.pmod(F.xxhash64("id", "node"), F.col(n))
    rest = held.filter("label <> main").select("node", dealt("rests").alias("rest"), F.explode(spread("parts")).alias("part"), F.lit(0).alias("side"), "id", "label", *S)
    every = held.select("node", F.explode(spread("rests")).alias("rest"), dealt("parts").alias("part"), F.lit(1).alias("side"), "id", "label", *S)
    return grouped(rest.union(every).join(texts, "id"), ["node", "rest", "part"], lambda g: _across(g, similar), LINKS)


def shared_counts(left: np.ndarray, right: np.ndarray, sets: list[np.ndarray]) -> np.ndarray:
    """How many members sets[left[i]] and sets[right[i]] have in common; left comes sorted."""
    out = np.zeros(len(left), dtype="i8")
    marked = np.zeros(max((int(s[-1]) for s in sets if len(s)), default=0) + 1, dtype=bool)
    size = np.array([len(s) for s in sets])
    cuts = np.flatnonzero(np.diff(left)) + 1
    for s, e in zip([0, *cuts.tolist()], [*cuts.tolist(), len(left)], strict=True):
        own = sets[left[s]]
        marked[own] = True
        ends = np.cumsum(size[right[s:e]])
        upto = np.concatenate([[0], np.cumsum(marked[np.concatenate([sets[r] for r in right[s:e]])])])
        out[s:e] = upto[ends] - upto[ends - size[right[s:e]]]
        marked[own] = False
    return out


def confirmed(pairs: DataFrame, texts: DataFrame, tasks: int | None = None, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """The pairs whose full sets have at least the similarity, as (a, b).

    Ids are dealt to buckets of about BUCKET, pairs to blocks of two buckets; a block gets each of its
    texts once. Blocks are judged together while their texts are few, and in parts when they are long.
    """
    part, whole = similar
    buckets = rows_in(texts) // BUCKET + 1

    def judged(a, b, held):
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        found, at = [], 0
        while at < len(a):
            size, number, end = 0, {}, at
            while end < len(a) and (size < TOGETHER or end == at):
                for i in (int(a[end]), int(b[end])):
                    if i not in number:
                        number[i] = len(number)
                        size += sum(zstandard.frame_content_size(t) for t in held[i])
                end += 1
            # an id may have several texts, and any two of them may link
            owner = [(i, t) for i in number for t in held[i]]
            sets = exact_sets([zstandard.ZstdDecompressor().decompress(t) for _, t in owner])
            places: dict[int, list[int]] = {}
            for k, (i, _) in enumerate(owner):
                places.setdefault(i, []).append(k)
            meet = np.array([(k, x, y) for k in range(at, end) for x in places[int(a[k])] for y in places[int(b[k])]], dtype="i8").reshape(-1, 3)
            meet = meet[np.argsort(meet[:, 1], kind="stable")]
            n = np.array([len(s) for s in sets], dtype="i8")
            both = shared_counts(meet[:, 1], meet[:, 2], sets)
            ok = (both > 0) & (whole * both >= part * (n[meet[:, 1]] + n[meet[:, 2]] - both))
            found.append(np.unique(meet[ok, 0]))
            at = end
        at = np.concatenate(found)
        return pa.RecordBatch.from_arrays([pa.array(x[at], pa.int64()) for x in (a, b)], ["a", "b"])

    def run(batches):
        mark, held, a, b, size = None, {}, [], [], 0
        for batch in batches:
            for left, right, id_, other, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (left, right) != mark:
                    mark = (left, right)
                    if size >= TOGETHER // 4 and a:
                        yield judged(np.array(a), np.array(b), held)
                        held, a, b, size = {}, [], [], 0
                if other is None:
                    if text not in held.setdefault(id_, []):
                        held[id_].append(text)
                        size += zstandard.frame_content_size(text)
                else:
                    a.append(id_), b.append(other)
        if a:
            yield judged(np.array(a), np.array(b), held)

    bucket = lambda c: F.pmod(F.xxhash64(c), F.lit(buckets))
    dealt = pairs.select(bucket("a").alias("left"), bucket("b").alias("right"), F.col("a").alias("id"), F.col("b").alias("other"))
    needed = dealt.select("left", "right", F.explode(F.array("id", "other")).alias("id")).distinct()
    held = needed.join(texts, "id").select("left", "right", "id", F.lit(None).cast("long").alias("other"), "text")
    rows = held.union(dealt.withColumn("text", F.lit(None).cast("binary")))
    met = rows.repartition(partitions(pairs.sparkSession), "left", "right").sortWithinPartitions("left", "right", F.col("other").asc_nulls_first())
    with arrow_rows(pairs.sparkSession, 256):
        return staged(met.mapInArrow(tidy(run), "a bigint, b bigint"), "confirmed", tasks)


def squeezed_texts(df: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text) of the wanted ids, a staged table; texts compressed before they move."""

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            squeezed = [press.compress((t or "").encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(squeezed, pa.binary())], ["id", "text"])

    small_batches(df.sparkSession)
    wanted = by_ids(df.select(whole_id(df, id_col).alias("id"), F.col(text_col).alias("text")), ids, "id", "left_semi", lambda rows: rows.mapInArrow(tidy(run), "id bigint, text binary"))
    return staged(wanted, "texts")


def confirmed_links(df: DataFrame, pairs: DataFrame, id_col: str, text_col: str, tasks: int) -> DataFrame:
    """Of the staged pairs (a, b, agree), confirmed ones that connect what all confirmed ones connect."""
    ids = staged(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "paired", tasks)
    texts = squeezed_texts(df, ids, id_col, text_col)
    both = pairs.union(pairs.select("b", "a", "agree"))
    likeliest = both.groupBy("a").agg(F.max(F.struct("agree", F.xxhash64("b"), "b")).alias("x")).select("a", F.col("x.b").alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sure = confirmed(likeliest, texts, tasks)
    known = components(sure)
    left = pairs.join(known.toDF("a", "c_a"), "a", "left").join(known.toDF("b", "c_b"), "b", "left")
    left = staged(left.filter(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b"), "left", tasks)
    return confirmed(left, texts, tasks).union(sure) if rows_in(left) else sure


def links(df: DataFrame, classes: DataFrame, id_col: str, text_col: str, tasks: int) -> DataFrame:
    """Confirmed links (a, b) between class representatives that give the components."""
    members, any_large = first_level(classes, tasks)
    found = grouped(members.filter(F.col("n") <= SMALL).select("node", "id", "label", *S), ["node"], _exhaustive, PAIRS)
    large = members.filter(F.col("n") > SMALL)
    sure = confirmed_links(df, staged(_best(found.union(starred(large)) if any_large else found), "candidates", tasks), id_col, text_col, tasks)
    if any_large:
        sure = sure.union(further_levels(df, large, components(sure), classes, id_col, text_col, tasks))
    return sure


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every document."""
    signed = signatures(df, id_col, text_col)
    tasks = tasks_for(rows_in(signed) * TREES, ROWS_PER_TASK)
    sets = signed.filter("n_shingles > 0 and id is not null")
    # only sets that several ids have need a name; their smallest id is it
    repeated = sets.groupBy("d0", "d1").agg(F.min("id").alias("class_id"), F.max("id").alias("last")).filter("class_id <> last").drop("last")
    named = by_ids(signed, staged(repeated, "repeated", tasks), ["d0", "d1"], "left")
    named = named.withColumn("class_id", F.when(F.col("n_shingles") > 0, F.coalesce("class_id", "id")))
    classes = staged(named.filter("id = class_id").select("id", "first", "further", *S), "classes", tasks)
    found = components(links(df, classes, id_col, text_col, tasks).union(_same_id(named)))
    named = by_ids(named.select("id", "n_shingles", "class_id"), found.toDF("class_id", "component"), "class_id", "left")
    component = F.when(F.col("id").isNull() | (F.col("n_shingles") == 0), F.col("id")).otherwise(F.coalesce("component", "class_id"))
    out = named.select("id", "n_shingles", component.alias("component_id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _same_id(named: DataFrame) -> DataFrame:
    """Links between the classes of texts that share an id."""
    sets = named.filter("class_id is not null")
    several = sets.groupBy("id").agg(F.min("class_id").alias("a"), F.max("class_id").alias("b"), F.min("d0").alias("x"), F.max("d0").alias("y"))
    own = sets.join(several.filter("x <> y").select("id"), "id")
    return own.select(F.col("id").alias("a"), F.col("class_id").alias("b")).distinct()
