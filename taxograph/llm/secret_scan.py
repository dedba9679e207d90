"""Secret scan with dictionary-primed zstandard novelty.

Base detectors find assignments, access keys and long hexadecimal runs. Besides them, every token of
LEAST characters within WINDOW characters of a sensitive word, before or after it and over words and
lines, is a candidate: the bytes it adds to the compressed form of the code
around it, with a zstandard dictionary of common identifiers loaded, over its length is its novelty.
Names and words are cheap there, key material is not; candidates at or above `novelty` are reported
as kind "novel" unless they overlap a base span.

Defined cases: a null text counts as empty and has no spans; empty and very long texts are scanned
whole; repeated rows and ids are scanned one by one; other columns are not carried, so names cannot
clash; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxograph.llm import spans as S
from taxograph.llm.common import small_batches

KINDS = {"assign": 0, "access": 1, "hex": 2, "novel": 3}
SENSITIVE = ("password", "passwd", "secret", "token", "api_?key", "pwd", "credential", "private_?key", "bearer", "auth_?key", "client_?id")
#: Identifiers and phrases that are common near settings and in code.
IDENTIFIERS = (
    "password passwd secret token api_key apikey access_key private_key client_id client_secret credential authorization bearer "
    "username user_name email address config configuration settings default example placeholder changeme undefined null none true false "
    "string number boolean integer object function return import export const value values variable environment production development "
    "localhost connection database server request response header content type application json text html https http www com org net "
    "your-token-here your_secret_here your_api_key insert-password-here the and that with from this have will which their "
)
CONTEXT, REACH, LEAST, WINDOW = 256, 24, 12, 128
#: A sensitive word, then within REACH characters without letters or digits the candidate.
CANDIDATE = re.compile("(?:" + "|".join(map(S._either_case, SENSITIVE)) + r")[A-Za-z_]{0,12}[^A-Za-z0-9\n]{1,%d}([A-Za-z0-9+/_=.~!@#$%%^&*-]{%d,})" % (REACH, LEAST))
#: Any other token, wherever it stands near a sensitive word.
TOKEN = re.compile("[A-Za-z0-9][A-Za-z0-9+/_=.~!@#$%%^&*-]{%d,}" % (LEAST - 1))
HINT = re.compile("|".join(map(S._either_case, SENSITIVE)))


class Novelty:
    """Marginal compressed bytes of a string, given the text before it and the identifiers."""

    def __init__(self, identifiers: str = IDENTIFIERS):
        words = zstandard.ZstdCompressionDict(identifiers.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=words, write_content_size=False, write_checksum=False)

    def __call__(self, before: str, candidate: str, after: str = "") -> float:
        """Added bytes per byte of the candidate."""
        around = (before + "\n" + after).encode("utf-8", "surrogatepass")
        raw = candidate.encode("utf-8", "surrogatepass")
        return (len(self.compressor.compress(around + b"\n" + raw)) - len(self.compressor.compress(around + b"\n"))) / len(raw)


def candidates(text: str) -> Iterator[S.Span]:
    """What follows a sensitive word directly, then all further tokens in a window around one."""
    direct = [("novel", *m.span(1)) for m in CANDIDATE.finditer(text)]
    yield from direct
    hints = [m.span() for m in HINT.finditer(text)]
    near, held = 0, S.Taken(direct)
    for m in TOKEN.finditer(text):
        start, end = m.span()
        while near < len(hints) and hints[near][1] + WINDOW < start:
            near += 1
        if near < len(hints) and hints[near][0] - WINDOW <= end and not held.overlaps(start, end):
            yield "novel", start, end


def scan(text: str, novelty: Novelty, least: float) -> tuple[list[S.Span], list[S.Span]]:
    """(base spans, added spans)."""
    base = S.access_spans(text) + S.hex_spans(text)
    added: list[S.Span] = []
    if HINT.search(text):
        base += S.assign_spans(text)
        held = S.Taken(base)
        for span in candidates(text):
            start, end = span[1:]
            if not held.overlaps(start, end) and novelty(text[max(0, start - CONTEXT) : start], text[start:end], text[end : end + CONTEXT // 4]) >= least:
                added.append(span)
    return base, added


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", novelty: float = 0.6) -> DataFrame:
    """(id, spans array<struct<kind,start,end,base>>) of every row, over whole texts."""
    small_batches(df.sparkSession)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches):
        measure = Novelty()
        for b in batches:
            found = []
            for t in b.column(1).to_pylist():
                base, added = scan(t, measure, novelty) if t else ([], [])
                found.append([{"kind": k, "start": s, "end": e, "base": k != "novel"} for k, s, e in base + added])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(found, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])))],
                ["id", "spans"],
            )

    out = df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>")
    return out.withColumnRenamed("id", id_col)


def span_digest(found: DataFrame, kinds: dict[str, int], counted: list[str], id_col: str) -> DataFrame:
    """The digest columns of (id, spans): counts of base kinds, sha256 of the base list, all spans."""

    def listed(column):
        order = F.transform(column, lambda x: F.struct(x["start"].alias("start"), F.element_at(F.create_map(*[v for k, n in kinds.items() for v in (F.lit(k), F.lit(n))]), x["kind"]).alias("order"), x["end"].alias("end"), x["kind"].alias("kind")))
        return F.array_join(F.transform(F.array_sort(order), lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")

    def counted_as(kind):
        return F.size(F.filter(base, lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter(F.col("spans"), lambda x: x["base"])
    return found.select(
        F.col(id_col),
        *map(counted_as, counted),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
