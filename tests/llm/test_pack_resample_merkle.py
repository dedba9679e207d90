"""Packing, resampling and the manifest against plain code."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from taxograph.llm import merkle, packing, resample

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


# --- packing


TEXTS = [None, "", " ", "Hello, world!", "It's 12 o'clock\r\n\tnow", "a b c\x1cd", "é É ΑΣ Σ ΑΣΑ", "<|endoftext|> x <|start", "x" * 300, "日本語 テキスト", "don't 'll 're " * 40, "a  b\n\nc"]


def test_chunks_give_the_ids_of_whole_texts():
    whole, encode = Tokenizer.from_file(VOCABULARY), packing.Encoder(VOCABULARY)
    rng = random.Random(3)
    made = ["".join(rng.choice("aAbéÉΣ '’.,12\n\t  ́\x1c<|>") for _ in range(rng.randrange(200))) for _ in range(300)]
    for t in [t for t in TEXTS if t] + made:
        assert np.frombuffer(encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids, t


def test_kept_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "KEPT", 5)
    encode, whole = packing.Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    for t in ("a b c d", "b e f g h i j", "a b"):
        assert np.frombuffer(encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids
        assert len(encode.known) <= 7


def best(lengths, capacity):
    """The fewest sequences, by trying all ways (small inputs)."""
    lengths, least = sorted(lengths, reverse=True), [len(lengths)]

    def put(k, rooms):
        if len(rooms) >= least[0]:
            return
        if k == len(lengths):
            least[0] = len(rooms)
            return
        for room in {r for r in rooms if r >= lengths[k]}:
            left = list(rooms)
            left.remove(room)
            put(k + 1, [*left, room - lengths[k]])
        put(k + 1, [*rooms, capacity - lengths[k]])

    put(0, [])
    return least[0]


def counts_of(lengths, capacity):
    return np.bincount(lengths, minlength=capacity + 1).astype("i8") if len(lengths) else np.zeros(capacity + 1, "i8")


def check_plan(plan, counts, capacity):
    fill, taken = defaultdict(list), Counter()
    for length, n, first, each, offset in plan.runs:
        taken[length] += n
        for k in range(n):
            fill[first + k // each].append((offset + k % each * length, length))
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in enumerate(counts.tolist()) if v}
    for parts in fill.values():
        upto = 0
        for offset, length in sorted(parts):
            assert offset == upto
            upto += length
        assert upto <= capacity
    assert len(fill) == plan.sequences >= packing.lower_bound(counts, capacity)


def test_reduction_keeps_the_optimum_and_best_fit_is_near_it():
    rng, reduced, over = random.Random(5), 0, 0
    for _ in range(400):
        capacity = rng.choice([10, 20, 37])
        low, high = rng.choice([(1, capacity), (capacity // 4, capacity), (1, capacity // 2)])
        lengths = [rng.randint(low or 1, high) for _ in range(rng.randint(1, 9))]
        counts = counts_of(lengths, capacity)
        plan, left = packing.Plan(capacity), packing.Lengths(counts)
        packing.reduce(left, plan)
        rest = [n for n in left.used for _ in range(left.count[n])]
        optimum = best(lengths, capacity)
        assert plan.sequences + best(rest, capacity) == optimum, (capacity, lengths)
        reduced += len(lengths) - len(rest)
        assert packing.lower_bound(counts, capacity) <= optimum
        plan = packing.planned(counts, capacity)
        check_plan(plan, counts, capacity)
        over += plan.sequences - optimum
    assert reduced > 1500 and over <= 8


def plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fit = [k for k, r in enumerate(rooms) if r >= n]
        if fit:
            rooms[min(fit, key=lambda k: rooms[k])] -= n
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_grouped_best_fit_is_plain_best_fit():
    rng = random.Random(6)
    for _ in range(200):
        capacity = rng.choice([16, 100])
        lengths = [rng.choice([1, 2, 3, 5, 8, rng.randint(1, capacity)]) for _ in range(rng.randint(0, 300))]
        counts, plan = counts_of(lengths, capacity), packing.Plan(capacity)
        packing.best_fit(packing.Lengths(counts), plan)
        check_plan(plan, counts, capacity)
        fill = Counter()
        for length, n, first, each, _ in plan.runs:
            for k in range(n):
                fill[first + k // each] += length
        assert sorted(capacity - v for v in fill.values()) == plain_best_fit(lengths, capacity)


def test_plan_does_not_grow_with_the_pieces():
    rng = np.random.default_rng(1)
    counts = np.concatenate([[0], rng.integers(0, 50, packing.CAPACITY)])
    small, large = packing.planned(counts), packing.planned(counts * 1_000_000)
    assert len(large.runs) < 3 * packing.CAPACITY and len(small.runs) < 3 * packing.CAPACITY
    assert large.sequences <= packing.lower_bound(counts * 1_000_000) * 1.005


def test_packed_documents(spark):
    rng = random.Random(8)
    words = ["alpha", "Beta,", "gamma's", "délta", "12"]
    rows = [(i, t, "x", "y") for i, t in enumerate(TEXTS)] + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 1, 5, 30, 90]))), None, None) for i in range(150)] + [(5, "twice", "", ""), (5, "twice", "", ""), (None, "no id", "", "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, id string, piece string").repartition(5)
    capacity, whole = 64, Tokenizer.from_file(VOCABULARY)
    got = packing.packed(df, VOCABULARY, capacity=capacity).collect()
    expected = []
    for i, t, *_ in rows:
        ids = (whole.encode(t, add_special_tokens=False).ids if t else []) + [1]
        for k in range(0, len(ids), capacity):
            part = ids[k : k + capacity]
            expected.append((-1 if i is None else i, k // capacity, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted((-1 if r[0] is None else r[0], *r[1:5]) for r in got) == sorted(expected)
    fill = defaultdict(list)
    for r in got:
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fill.values():
        assert [o for o, _ in sorted(parts)] == [sum(n for _, n in sorted(parts)[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= capacity
    lengths = counts_of([e[3] for e in expected], capacity)
    assert len(fill) == packing.planned(lengths, capacity).sequences <= packing.lower_bound(lengths, capacity) * 1.05 + 1
    held = packing.sequences(df, VOCABULARY, capacity=capacity).collect()
    assert len(held) == len(fill) and sum(len(r["ids"]) // 4 for r in held) == sum(e[3] for e in expected)
    crcs = Counter()
    for r in held:
        ends = [*r["starts"][1:], len(r["ids"]) // 4]
        crcs.update(zlib.crc32(bytes(r["ids"][4 * a : 4 * b])) for a, b in zip(r["starts"], ends, strict=True))
    assert crcs == Counter(e[4] for e in expected)
    assert packing.packed(df.limit(0), VOCABULARY).collect() == []


# --- resampling


def plain_features(text):
    w = WORD.findall(lower(text))
    return w + [f"{a} {b}" for a, b in itertools.pairwise(w)]


BYTES = [None, "", "a", "A b", "ab,", ",ab", "éÉ x9Z", "a\x00b", "w" * 60 + " " + "v" * 47 + "é", "日本 語", "x" * 5000, "a b " * 700]


@pytest.mark.parametrize("piece", [1, 3, 7, 64, 1 << 21])
def test_features_of_buffers(piece):
    for texts in (BYTES, BYTES[::-1], ["a", "b"], ["", ""], [None], []):
        for array in (pa.array(texts, pa.string()), pa.array(["zz zz", *texts], pa.string()).slice(1)):
            got = defaultdict(Counter)
            for document, crc in resample.features(*resample.buffers(array), piece=piece):
                for d, c in zip(document.tolist(), crc.tolist(), strict=True):
                    got[d][c] += 1
            for k, t in enumerate(texts):
                assert got[k] == Counter(zlib.crc32(f.encode()) for f in plain_features(t)), (k, piece)


def plain_resample(docs, target, share=25, least=20):
    s, t = [0] * 10_000, [0] * 10_000
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    for _, text in docs:
        for f in plain_features(text):
            s[bucket(f)] += 1
    for text in target:
        for f in plain_features(text):
            t[bucket(f)] += 1
    out = []
    for i, text in docs:
        fs = plain_features(text)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + 10_000) / ((s[b] + 1) * (sum(t) + 10_000)))) for b in map(bucket, fs)]
        weight = sum(gains) // len(fs) if fs else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    in_draw = sorted((r for r in out if r[1] >= 2 * least - 1), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(in_draw[: share * len(in_draw) // 100]):
        r[4] = k + 1
    return sorted(map(tuple, out), key=repr)


def test_resampling(spark):
    rng = random.Random(4)
    say = lambda n, v: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    docs = [(i, say(rng.choice([0, 5, 19, 20, 60]), 40 if i % 3 else 400)) for i in range(120)] + [(200, None), (201, ""), (202, "x" * 10_000), (None, say(30, 40)), (7, say(25, 40)), (300, "same " * 40), (300, "same " * 40)]
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id bigint, text string, id string, rank int").repartition(6)
    target = [say(50, 40) for _ in range(5)] + [None]
    tf = spark.createDataFrame([(t,) for t in target], "text string")
    got = sorted(map(tuple, resample.resample(df, tf).collect()), key=repr)
    assert got == plain_resample(docs, target)
    assert sorted(map(tuple, resample.resample(df, tf.limit(0)).collect()), key=repr) == plain_resample(docs, [])
    assert resample.resample(df.limit(0), tf).collect() == []
    counts = {r["bucket"]: r["n"] for r in resample.bucket_counts(df).collect()}
    assert sum(counts.values()) == sum(len(plain_features(t)) for _, t in docs)


# --- manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """(root, siblings left and right of each leaf, level by level)."""
    paths, level, members = [[] for _ in leaves], list(leaves), [[k] for k in range(len(leaves))]
    while len(level) > 1:
        nodes, owners = [], []
        for k in range(0, len(level), 16):
            run = level[k : k + 16]
            for j, below in enumerate(members[k : k + 16]):
                for leaf in below:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            nodes.append(H(*run)), owners.append([x for m in members[k : k + 16] for x in m])
        level, members = nodes, owners
    return level[0], paths


def plain_manifest(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append((r[0] is not None, r[0] or 0, plain_leaf(r), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([x[2] for x in sorted(groups[s], key=lambda x: x[:3])]) for s in order}
    root, above = plain_tree([trees[s][0] for s in order])
    out = []
    for g, s in enumerate(order):
        for (_, _, leaf, r), path in zip(sorted(groups[s], key=lambda x: x[:3]), trees[s][1], strict=True):
            path, h = path + above[g], leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                h = plain_leaf((*r[:4], lower(r[4]) if r[4] is not None else None))
            for left, right in path:
                h = H(left, h, right)
            out.append((r[0], leaf, trees[s][0], root, H(*(a + b for a, b in path)), h, h == root))
    return sorted(out, key=repr)


DOCUMENTS = "doc_id bigint, source string, lang string, n_chars bigint, text string"


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17, None: 1}, {"a": 300, "b": 256, "": 2, "é": 1, "z": 33, None: 16}, {f"s{k}": 1 + k % 3 for k in range(40)}])
def test_manifest(spark, sizes):
    rng, i = random.Random(9), 0
    rows = []
    for s, n in sizes.items():
        for _ in range(n):
            i += 1
            text = rng.choice([None, "", "Upper", "lower", "É" * rng.randrange(9), "Long " * rng.randrange(400)])
            rows.append((rng.choice([i, i, i, 3]) if i > 5 else i, s, rng.choice([None, "en"]), rng.choice([None, len(text or "")]), text))
    rows += [(None, next(iter(sizes)), None, None, None), rows[0]]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], DOCUMENTS + ", key string, digest int").repartition(7)
    got = sorted(map(tuple, merkle.tamper_check(df).collect()), key=repr)
    assert got == plain_manifest(rows)
    assert any(not r[-1] for r in got) or len(rows) < 30


def test_manifest_of_nothing(spark):
    assert merkle.tamper_check(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_mountains_cut_anywhere():
    leaves = [H(str(k)) for k in range(1100)]
    for cuts in ([], [1], [16, 256, 272], [5, 700], [255, 257, 1099]):
        nodes, carried = [], []
        for a, b in itertools.pairwise([0, *cuts, 1100]):
            stack = merkle.Mountains(lambda *n: nodes.append(n))
            for k in range(a, b):
                stack.push(k, leaves[k])
            stack.close()
        level, expected = 0, leaves
        while len(expected) > 1:
            parts = defaultdict(list)
            for lv, run, first, members in nodes + carried:
                if lv == level:
                    parts[run].append((first, members))
            joined = ["".join(m for _, m in sorted(parts[r])) for r in sorted(parts)]
            assert joined == ["".join(expected[k : k + 16]) for k in range(0, len(expected), 16)]
            expected = [H(j) for j in joined]
            level += 1
            full = {run for lv, run, first, members in nodes if lv == level - 1 and first == 0 and len(members) == 1024}
            carried = [(level, run // 16, run % 16, d) for run, d in enumerate(expected) if run not in full]


def test_changed_runs(spark):
    rows = [(k, "a", "en", 1, f"text {k}") for k in range(100)]
    old = merkle.manifest(spark.createDataFrame(rows, DOCUMENTS))
    rows[37] = (37, "a", "en", 1, "Text 37")
    new = merkle.manifest(spark.createDataFrame(rows, DOCUMENTS))
    assert merkle.changed_runs(old, new).collect() == [("sa", 2)]
