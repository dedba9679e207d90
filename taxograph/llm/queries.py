"""The queries opN_<name> and pipeline, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from taxograph.llm import decontaminate, hilbert_shards, merkle, mixing, near_dedup, packing, pii, quality_lm, resample, secret_scan, topk_search, url_filter, warc

URL_RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]

SHARDS = 16
#: CRC-32 of a text's bytes in SQL: the table from the reflected polynomial, then byte by byte.
CRC_TABLES = "crc0 AS (SELECT i AS n, i::UBIGINT AS c FROM range(256) r(i)), " + ", ".join(f"crc{k + 1} AS (SELECT n, xor(c >> 1, 3988292384::UBIGINT * (c & 1)) AS c FROM crc{k})" for k in range(8)) + ", crc AS (SELECT list(c ORDER BY n) AS crc_of FROM crc8)"
CRC32 = """xor(4294967295::UBIGINT, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda p: ('0x' || p)::UBIGINT)), lambda c, b: xor(c >> 8, crc_of[(xor(c & 255, b) + 1)::BIGINT])))::BIGINT"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"), URL_RULES)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.secret_spans(table(spark, sf_dir, "documents"))
    return secret_scan.span_digest(found, secret_scan.KINDS, ["assign", "access", "hex"], "doc_id")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.hilbert_shards(table(spark, sf_dir, "documents"), SHARDS).drop("curve")


def op8_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality_lm.quality(table(spark, sf_dir, "documents"), trusted)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.pii_spans(table(spark, sf_dir, "documents"))
    return secret_scan.span_digest(found, pii.KINDS, ["email", "ip", "card", "phone"], "doc_id")


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(table(spark, sf_dir, "documents"))


def resample_sql() -> str:
    """Features in SQL; CRC-32 byte by byte over the distinct features."""
    words = r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
    runs = "w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH {CRC_TABLES},
dw AS (SELECT row_number() OVER () AS row_id, doc_id, {words} AS w FROM documents),
df AS (SELECT row_id, unnest({runs}) AS text FROM dw),
bf AS (SELECT unnest({runs}) AS text FROM (SELECT {words} AS w FROM benchmark)),
kinds AS MATERIALIZED (SELECT text, {CRC32} % 10000 AS bucket FROM (SELECT text FROM df UNION SELECT text FROM bf), crc),
d AS MATERIALIZED (SELECT row_id, bucket FROM df JOIN kinds USING (text)),
s AS (SELECT bucket, count(*) AS s FROM d GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN kinds USING (text) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS all_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS all_t),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (all_s + 10000) / ((s::DOUBLE + 1) * (all_t + 10000))))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket), sums),
weighed AS (SELECT row_id, count(*) AS n, floor(sum(gain) / count(*))::BIGINT AS weight FROM d JOIN gains USING (bucket) GROUP BY row_id),
scored AS (
  SELECT row_id, doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM dw LEFT JOIN weighed USING (row_id)),
placed AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS eligible FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 25 * eligible // 100 THEN place END AS rank FROM placed"""


def merkle_sql(levels: int = 8) -> str:
    """Both trees level by level, then the path of every document; a tree has `levels` levels at most."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(text if c == "text" else c) for c in merkle.FIELDS) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def tree(name: str) -> str:
        steps = []
        for k in range(levels):
            steps.append(f"{name}_runs{k} AS (SELECT src, n, i // 16 AS run, string_agg(d, '' ORDER BY i) AS m FROM {name}{k} WHERE n > 1 GROUP BY src, n, i // 16)")
            steps.append(f"{name}{k + 1} AS (SELECT src, (n + 15) // 16 AS n, run AS i, sha256(m) AS d FROM {name}_runs{k} UNION ALL SELECT src, n, i, d FROM {name}{k} WHERE n = 1)")
        return ", ".join(steps)

    def climb(name: str, k: int) -> str:
        left, right = "m[1:64 * (i % 16)]", "m[64 * (i % 16) + 65:]"
        return f"""{name}_path{k + 1} AS (
  SELECT p.* EXCLUDE (i, h, proof), CASE WHEN m IS NULL THEN i ELSE i // 16 END AS i, CASE WHEN m IS NULL THEN h ELSE sha256({left} || h || {right}) END AS h,
         CASE WHEN m IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
  FROM {name}_path{k} p LEFT JOIN {name}_runs{k} r ON p.src = r.src AND r.run = p.i // 16)"""

    return f"""
WITH {CRC_TABLES},
hashed AS (
  SELECT doc_id, coalesce('s' || source, '') AS src, {leaf('text')} AS leaf, CASE WHEN {CRC32.replace("coalesce(text, '')", "doc_id::VARCHAR")} % 5 = 0 THEN {leaf(lowered)} END AS tampered
  FROM documents, crc),
numbered AS (SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY src) AS n FROM hashed),
low0 AS (SELECT src, n, i, leaf AS d FROM numbered), {tree('low')},
groups AS (SELECT src AS source_key, row_number() OVER (ORDER BY src) - 1 AS i, count(*) OVER () AS n, d FROM low{levels}),
top0 AS (SELECT 0 AS src, n, i, d FROM groups), {tree('top')},
low_path0 AS (SELECT doc_id, src, leaf, i, coalesce(tampered, leaf) AS h, '' AS proof FROM numbered), {', '.join(climb('low', k) for k in range(levels))},
top_path0 AS (SELECT doc_id, 0 AS src, leaf, g.d AS subroot, h, proof, g.i FROM low_path{levels} p JOIN groups g ON p.src = g.source_key), {', '.join(climb('top', k) for k in range(levels))}
SELECT doc_id, leaf, subroot, root.d AS root, sha256(proof) AS proof_sha256, h AS folded_root, h = root.d AS verified FROM top_path{levels}, top{levels} AS root"""


def hilbert_sql(shards: int = SHARDS) -> str:
    """The shards in SQL: one common table per bit plane of the curve."""
    bits, n = hilbert_shards.BITS, hilbert_shards.DIMS
    inverse, entry, direction = hilbert_shards.gray_tables(n)
    at = lambda t, i: f"(CASE {i} {' '.join(f'WHEN {k} THEN {v}' for k, v in enumerate(t))} END)"

    def turned(value, by, left):
        def up(k):
            return f"((({value} << {k}) | ({value} >> {n - k})) & {(1 << n) - 1})" if k else value

        return f"(CASE {by} {' '.join(f'WHEN {k} THEN {up(k if left else (n - k) % n)}' for k in range(n))} END)"

    steps, last = [], "cells"
    for b in reversed(range(bits)):
        plane = f"(((x >> {b}) & 1) | (((y >> {b}) & 1) << 1) | (((z >> {b}) & 1) << 2))"
        steps.append(f"w{b} AS (SELECT *, {at(inverse, turned(f'xor({plane}, e)', f'((d + 1) % {n})', False))} AS w FROM {last})")
        steps.append(f"s{b} AS (SELECT * EXCLUDE (w, h, e, d), h * {1 << n} + w AS h, xor(e, {turned(at(entry, 'w'), f'((d + 1) % {n})', True)}) AS e, (d + {at(direction, 'w')} + 1) % {n} AS d FROM w{b})")
        last = f"s{b}"
    rank = lambda c: f"(SELECT {c} AS value, ((row_number() OVER (ORDER BY {c} NULLS LAST) - 1) * {1 << bits}) // greatest(count(*) OVER (), {1 << bits}) AS cell FROM (SELECT DISTINCT {c} FROM documents))"
    return f"""
WITH {CRC_TABLES},
sized AS (SELECT doc_id, source, lang, coalesce(strlen(text), 0) + 1 AS size, text FROM documents),
cells AS (
  SELECT doc_id, size, text, a.cell AS x, b.cell AS y, least(length(bin(size)) - 1, {(1 << bits) - 1}) AS z, 0::BIGINT AS h, 0::BIGINT AS e, 0::BIGINT AS d
  FROM sized JOIN {rank('source')} a ON source IS NOT DISTINCT FROM a.value JOIN {rank('lang')} b ON lang IS NOT DISTINCT FROM b.value),
{', '.join(steps)},
placed AS (SELECT *, row_number() OVER (ORDER BY h, doc_id NULLS LAST, size) - 1 AS pos, count(*) OVER () AS n FROM {last}),
sharded AS (SELECT *, (pos * {shards}) // n AS shard FROM placed)
SELECT doc_id, size, {CRC32} AS text_crc32, 'rows' AS law, shard::INTEGER AS shard, pos - (shard * n + {shards - 1}) // {shards} AS slot, NULL::INTEGER AS grown_shard
FROM sharded, crc"""


QUERIES = {
    "op1_warc": op1_warc,
    "op2_url_filter": op2_url_filter,
    "op3_secret_scan": op3_secret_scan,
    "op4_mixing": op4_mixing,
    "op5_decontaminate": op5_decontaminate,
    "op6_near_dedup": op6_near_dedup,
    "op7_hilbert_shards": op7_hilbert_shards,
    "op8_quality_lm": op8_quality_lm,
    "op9_pii": op9_pii,
    "op10_topk_search": op10_topk_search,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_importance_resampling": op12_importance_resampling,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_warc": """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM hashed)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM firsts""",
    "op4_mixing": r"""
WITH sized AS (SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END AS size FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight FROM sized GROUP BY source),
level AS (
  SELECT *, 2.0 * source_size / weight AS full_at,
         (1.5 * sum(source_size) OVER () - (sum(2.0 * source_size) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING) - 2.0 * source_size))
         / sum(weight) OVER (ORDER BY 2.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_level
  FROM per),
common AS (SELECT arg_min(at_level, full_at) AS at_level FROM level WHERE full_at >= at_level),
targets AS (SELECT source, source_size, least(2.0 * source_size, weight * common.at_level) AS target FROM level, common),
spans AS (SELECT *, sum(round(target)::HUGEINT) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) AS high, round(target)::HUGEINT AS quota FROM targets),
total AS (SELECT sum(quota) AS words, greatest(least(20, floor(log2(greatest(sum(quota), 1)))), ceil(log2(greatest(sum(quota), 1) / 2048.0 + 1)))::INTEGER AS bits FROM spans),
points AS (SELECT slot, bits, words, ((list_sum(list_transform(range(bits), lambda b: ((slot >> b) & 1) << (bits - 1 - b)))::HUGEINT * words) >> bits) AS place FROM total, LATERAL (SELECT unnest(range((1::BIGINT << bits))) AS slot)),
slots AS (SELECT source, slot, row_number() OVER (PARTITION BY source ORDER BY slot) - 1 AS block_no FROM points JOIN spans ON place >= high - quota AND place < high),
given AS (SELECT source, (count(*)::HUGEINT * any_value(words)) >> any_value(bits) AS words_given FROM slots, total GROUP BY source),
placed AS (
  SELECT doc_id, source, size, sum(size) OVER (PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size ROWS UNBOUNDED PRECEDING) - size AS low FROM sized),
read AS (
  SELECT placed.*, source_size, target, coalesce(words_given, 0) AS words_given, (((low + 1)::HUGEINT << bits) - 1) // words AS first_block, (((low + source_size + 1)::HUGEINT << bits) - 1) // words AS again_block
  FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source LEFT JOIN given ON placed.source IS NOT DISTINCT FROM given.source, total)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(low + size, words_given) - low) + greatest(0, least(low + source_size + size, words_given) - low - source_size))::BIGINT AS taken,
       (SELECT min(slot) FROM slots WHERE size > 0 AND slots.source IS NOT DISTINCT FROM read.source AND (block_no BETWEEN first_block AND (((low + size)::HUGEINT << bits) - 1) // words OR block_no BETWEEN again_block AND (((low + source_size + size)::HUGEINT << bits) - 1) // words)) AS first_slot
FROM read, total""",
    "op2_url_filter": r"""
WITH parsed AS (
  SELECT page_id,
         CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
rules(verdict, rule_host, rule_path) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'), ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
fits AS (
  SELECT page_id, host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule, arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parsed LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY page_id, host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits
""",
}
ORACLE["op7_hilbert_shards"] = hilbert_sql()
ORACLE["op12_importance_resampling"] = resample_sql()
ORACLE["op13_merkle_manifest"] = merkle_sql()
ORACLE["op5_decontaminate"] = r"""
WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM bw WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
grams AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lengths WHERE len(w) >= n)),
found AS (SELECT doc_id, i, grams.n, item_id FROM grams JOIN windows ON grams.n = windows.n AND grams.phrase = windows.phrase),
hit AS (SELECT doc_id, count(DISTINCT at_word) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS at_word FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id)
SELECT dw.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)"""
ORACLE["op10_topk_search"] = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""
ORACLE["op6_near_dedup"] = r"""
WITH RECURSIVE dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM dw WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM least_of LEFT JOIN sizes USING (doc_id)"""
