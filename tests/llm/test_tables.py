"""WARC, mixing, Hilbert shards and top-k against plain code."""

from __future__ import annotations

import hashlib
import io
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from taxograph.llm import hilbert_shards, mixing, topk_search, warc

PAGES = [(5, "http://a", "x" * 200), (2, "http://b", "x" * 200), (9, None, "x" * 200), (1, "http://c", "small"), (3, "http://d", "small"), (4, "u\nv", None), (6, "", ""), (None, "n", "x" * 200), (7, "ü", "é" * 60), (8, "ü", "é" * 60), (2, "http://b", "x" * 200), (10, "z", "\r\n\r\nWARC/1.1\r\n" * 9000)]


def pages(spark):
    return spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id long, url string, html string, record_type string")


def test_warc_round_trip(spark):
    firsts = {}
    for i, _, h in PAGES:
        raw = (h or "").encode()
        if len(raw) >= 100 and i is not None:
            firsts[raw] = min(firsts.get(raw, i), i)
    want = Counter()
    for i, _, h in PAGES:
        raw = (h or "").encode()
        first = firsts.get(raw)
        revisit = first is not None and first != i
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None] += 1
    got = Counter(tuple(r)[:5] for r in warc.round_trip(pages(spark)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect())
    assert got == want
    assert warc.round_trip(pages(spark).limit(0)).count() == 0


def test_warc_payloads_and_rotation(spark):
    from taxograph.llm.common import new_path

    manifest = warc.write_archives(pages(spark).coalesce(1), new_path(spark, "warc"), archive_bytes=600)
    assert manifest.count() > 3 and manifest.agg(F.sum("records")).first()[0] == len(PAGES)
    back = {r.page_id: bytes(r.payload) for r in warc.read_archives(manifest, payloads=True).filter("record_type = 'response'").collect()}
    assert back[10] == PAGES[-1][2].encode() and back[4] == b""


def test_warc_reader_refuses_damage():
    one = warc.record(1, "http://a", b"p" * 5000, hashlib.sha256(b"p" * 5000).hexdigest(), None)
    two = warc.record(2, None, b"", hashlib.sha256(b"").hexdigest(), 1)
    got = list(warc.read_records(io.BytesIO(one + two), payloads=True))
    assert [r["page_id"] for r in got] == [1, 2] and got[0]["payload"] == b"p" * 5000 and got[1]["record_offset"] == len(one)
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(one[:-9])))
    plain = zlib.decompress(one, 31)
    gz = lambda raw: (c := zlib.compressobj(1, zlib.DEFLATED, 31)).compress(raw) + c.flush()
    for broken in (plain.replace(b"ppp", b"qpp", 1), plain[:-4] + b"xxxx", plain + b"more", plain.replace(b"Content-Length: 5", b"Content-Length: 9", 2)):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(gz(broken))))
    wrong = warc.record(1, None, b"p" * 500, hashlib.sha256(b"q").hexdigest(), None)
    with pytest.raises(ValueError, match="payload"):
        list(warc.read_records(io.BytesIO(wrong)))


def plain_targets(sizes):
    """Shares by weight, capped, the excess shared again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        for s in full or open_:
            target[s] = 2.0 * sizes[s] if full else weight[s] * level
        left -= sum(target[s] for s in full)
        open_ = open_ - full if full else set()
    return target


def documents(spark, n=400, seed=1):
    rng = random.Random(seed)
    rows = [(k, " ".join("w" for _ in range(rng.choice([0, 1, 3, 40, 200]))), rng.choice(["a", "a", "a", "b", "é", "z", None])) for k in range(n)]
    rows += [(n, None, "b"), (n + 1, "x\u00a0y z", "only"), (0, rows[0][1], rows[0][2]), (None, "one two", "b")]
    return rows, spark.createDataFrame([(*r, "en", "clash") for r in rows], "doc_id long, text string, source string, lang string, target string")


def test_mix(spark):
    rows, df = documents(spark)
    got = mixing.mix(df).collect()
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").replace("\u00a0", "_").split())
    target = plain_targets(sizes)
    assert len(got) == len(rows)
    source = {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        source.setdefault((r.source_size, round(r.target, 6)), [0, 0])
        source[r.source_size, round(r.target, 6)][0] += r.taken
        source[r.source_size, round(r.target, 6)][1] += r["size"]
    for s, n in sizes.items():
        assert abs(source[n, round(target[s], 6)][0] - target[s]) <= 2 + sum(target.values()) / 2 ** mixing.slot_bits(round(sum(target.values())))
    again = mixing.mix(df.repartition(7)).collect()
    assert Counter(tuple(r) for r in got) == Counter(tuple(r) for r in again)
    assert mixing.mix(df.limit(0)).count() == 0


def plain_schedule(quotas, bits):
    """Slot by slot: the source of each, and its rank there."""
    words, rank, out = sum(quotas.values()), Counter(), []
    for slot in range(1 << bits):
        place = int(format(slot, f"0{bits}b")[::-1], 2) * words >> bits if bits else 0
        low = 0
        for key, quota in quotas.items():
            if low <= place < low + quota:
                out.append((slot, key, rank[key]))
                rank[key] += 1
            low += quota
    return out


@pytest.mark.parametrize("quotas", [{"sa": 5000, "sb": 3000, "sc": 2000}, {"sa": 1, "sb": 0, "sc": 70_001, "t": 13}])
def test_schedule_has_low_discrepancy(spark, quotas):
    rows, low = [], 0
    for key, q in quotas.items():
        rows.append((key, q, float(q), q, low, low + q))
        low += q
    targets = spark.createDataFrame(rows, "key string, source_size long, target double, quota long, low long, high long")
    blocks = mixing.Blocks(low, mixing.slot_bits(low))
    got = sorted((r.slot, r.key, r.block_no) for r in mixing.schedule(targets, blocks).collect())
    assert got == plain_schedule(quotas, blocks.bits)
    for n in (16, 100, 1000, 1 << blocks.bits):
        head = Counter(k for _, k, _ in got[:n])
        assert all(abs(head[k] - n * q / low) <= 1 + n.bit_length() for k, q in quotas.items())


def test_blocks_cut_words_evenly(spark):
    for words, bits in ((1, 0), (7, 2), (1000, 9), (10**13 + 7, 31), (12_345, 13)):
        blocks = mixing.Blocks(words, bits)
        some = sorted({k * words // 5000 for k in range(5000)})
        rows = spark.createDataFrame([(w,) for w in some], "w long").select("w", blocks.holding(F.col("w")).alias("k")).select("w", "k", blocks.start(F.col("k")).alias("a"), blocks.start(F.col("k") + 1).alias("z")).collect()
        assert all(r.a <= r.w < r.z and r.a == r.k * words >> bits for r in rows)


def test_mix_takes_what_the_slots_give(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(k, " ".join("w" for _ in range(rng.choice([0, 1, 7, 300]))), f"s{rng.choice([0] * 8 + [1, 1, 2])}") for k in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "SLOT_BITS", 7)
    stream = mixing.mixed_stream(df).orderBy("slot", "from").collect()
    taken, first = Counter(), {}
    for r in stream:
        taken[r.doc_id] += r["to"] - r["from"]
        first.setdefault(r.doc_id, r.slot)
    got = mixing.mix(df).collect()
    assert {r.doc_id: (r.taken, r.first_slot) for r in got} == {k: (taken[k], first.get(k)) for k, *_ in rows}
    per = Counter()
    for r in stream:
        per[r.slot] += r["to"] - r["from"]
    words = round(sum(r.target for r in {r.source_size: r for r in got}.values()))
    assert all(n <= words // 128 + 1 for n in per.values())
    whole = {s: sum(len(t.split()) for _, t, x in rows if x == s) for s in ("s0", "s1", "s2")}
    wanted = plain_targets(whole)
    source = Counter()
    for k, _, s in rows:
        source[s] += taken[k]
    assert all(abs(source[s] - wanted[s]) <= words / 128 + 2 for s in whole)
    monkeypatch.setattr(mixing, "SLOT_BITS", 3)  # other points give other words
    assert {r.doc_id: r.taken for r in mixing.mix(df).collect()} != {k: taken[k] for k, *_ in rows}


def test_hilbert_curve_visits_neighbours(spark):
    n, bits = 3, 2
    grid = spark.range(1 << (n * bits)).select(*[F.expr(f"cast((id >> {bits * k}) & {(1 << bits) - 1} as int)").alias(c) for k, c in enumerate("xyz")])
    cells = {r.h: (r.x, r.y, r.z) for r in grid.withColumn("h", hilbert_shards.hilbert_index([F.col(c) for c in "xyz"], bits)).collect()}
    assert sorted(cells) == list(range(1 << (n * bits)))
    assert all(sum(abs(a - b) for a, b in zip(cells[k], cells[k + 1], strict=True)) == 1 for k in range(len(cells) - 1))


def test_shards(spark):
    rows, df = documents(spark)
    got = hilbert_shards.hilbert_shards(df, 16).collect()
    assert len(got) == len(rows)
    per = defaultdict(list)
    for r in got:
        per[r.shard].append(r.slot)
    counts = [len(v) for v in per.values()]
    assert len(per) == 16 and max(counts) - min(counts) <= 1 and all(sorted(v) == list(range(len(v))) for v in per.values())
    texts = {i: t for i, t, _ in rows}
    for r in got:
        raw = (texts[r.doc_id] or "").encode()
        assert r["size"] == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    few = hilbert_shards.hilbert_shards(df.limit(5), 16)
    assert few.count() == 5 and few.agg(F.max("slot")).first()[0] == 0
    assert hilbert_shards.hilbert_shards(df.limit(0), 16).count() == 0


def test_shards_prune(spark, tmp_path):
    _, df = documents(spark, 2000)
    out = hilbert_shards.hilbert_shards(df, 16, keep=("source",)).withColumn("b", F.length(F.bin("size")))
    spans = out.groupBy("shard").agg(F.min("b").alias("low"), F.max("b").alias("high"), F.count_distinct("source").alias("sources")).collect()
    assert sum(r.sources for r in spans) / 16 < 4
    hilbert_shards.write_shards(df.drop("target"), str(tmp_path / "s"), 4)
    assert spark.read.parquet(str(tmp_path / "s")).count() == df.count()


def plain_top(vectors, k, every):
    ints = {i: [int(np.floor(64 * float(x))) for x in v] for i, v in vectors}
    out = set()
    for q, v in ints.items():
        if q % every == 0:
            scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=True)), c) for c, w in ints.items() if c != q and len(w) == len(v)))
            out |= {(q, r, c, -s) for r, (s, c) in enumerate(scored[:k], 1)}
    return out


@pytest.mark.parametrize("scale", [1.0, 300.0, 1e6])
def test_top_k(spark, scale):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 8))
    vectors = [(k, (np.round(centres[k % 6] + 0.2 * rng.normal(size=8), 1) * scale).astype("f4").tolist()) for k in range(300)]
    vectors += [(400 + k, vectors[0][1]) for k in range(30)] + [(600, [0.5] * 3), (601, [1.0] * 3), (-20, vectors[7][1])]
    bad = [(700, None), (720, [None] + [1.0] * 7), (740, [float("nan")] * 8), (760, [float("inf")] * 8), (None, [1.0] * 8), (780, [])]
    df = spark.createDataFrame([(*v, "clash") for v in vectors + bad], "vec_id long, embedding array<float>, rank string")
    got = {tuple(r) for r in topk_search.top_k(df, 20, 20).collect()}
    assert got == plain_top(vectors, 20, 20)


def test_top_k_edges(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [1.0]), (0, [1.0])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk_search.top_k(df).collect()) == [(0, 1, 1, 4096)] * 2
    assert topk_search.top_k(df.limit(0)).count() == 0


def test_bounds_hold_at_every_depth():
    rng = np.random.default_rng(1)
    x, q = rng.integers(-9, 9, (200, 6)), rng.integers(-9, 9, (5, 6))
    lists = topk_search.Lists(np.arange(200), x)
    halves, exact = np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1).astype("f8"), q @ x.T
    for depth in (0.1, 0.5, 0.9, 1.0):
        upper, lower = (halves @ f for f in lists.at_depth(depth, "f8"))
        assert (lower <= exact).all() and (exact <= upper).all()
    assert (upper == exact).all() and (lower == exact).all()
