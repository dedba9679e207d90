"""Personal data: candidate spans from generators, gradient-boosted trees, calibrated thresholds.

Base detectors (email, ip, card, phone) always stand. High-recall generators propose further,
overlapping spans; boosted trees score their format and context, a threshold calibrated for
precision selects among them, and of overlapping winners the best score stays. Spans that overlap a
base span are not added.

The trees are fitted on the driver over a synthetic sample of TRAIN_ROWS candidates made from
templates with a fixed seed (a bound that does not depend on the input); nothing else is sampled.

Defined cases: a null text counts as empty; texts are scanned whole; repeated rows are scanned one by
one; only the id and the text are read, so names cannot clash; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from taxograph.llm import spans as S
from taxograph.llm.common import small_batches

KINDS = {"email": 0, "ip": 1, "card": 2, "phone": 3, "spelled_email": 4, "local_phone": 5, "national_id": 6, "iban": 7, "birth_date": 8}
TRAIN_ROWS, SEED, PRECISION = 6000, 20260, 0.995
CONTEXT = 40

GENERATORS: dict[str, re.Pattern] = {
    "spelled_email": re.compile(r"(?<![A-Za-z0-9._-])[A-Za-z0-9._-]{1,64}+\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{1,64}+(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[A-Za-z0-9-]{1,64}+){1,4}+"),
    "local_phone": re.compile(r"(?<![0-9+A-Za-z])\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,5}){1,4}(?![0-9A-Za-z])"),
    "national_id": re.compile(r"(?<![0-9A-Za-z-])[0-9]{3}[-\x20][0-9]{2}[-\x20][0-9]{4}(?![0-9A-Za-z-])"),
    "iban": re.compile(r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{2,4}){3,8}(?:\x20?[A-Z0-9])?(?![0-9A-Za-z])"),
    "birth_date": re.compile(r"(?<![0-9A-Za-z])[0-9]{1,4}[./-][0-9]{1,2}[./-][0-9]{1,4}(?![0-9A-Za-z])"),
}
#: Context words per added kind.
CUES = {
    "spelled_email": ("email", "mail", "contact", "write", "reach"),
    "local_phone": ("phone", "tel", "call", "mobile", "cell", "fax", "contact"),
    "national_id": ("ssn", "social", "security", "national", "tax", "insurance"),
    "iban": ("iban", "account", "bank", "transfer", "konto", "compte"),
    "birth_date": ("born", "birth", "dob", "birthday", "geboren", "nacido"),
}
ALL_CUES = sorted({w for v in CUES.values() for w in v})


def mod97(s: str) -> bool:
    s = s.replace(" ", "")
    digits = "".join(str(int(c, 36)) for c in s[4:] + s[:4])
    return int(digits) % 97 == 1


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of one candidate."""
    s = text[start:end]
    before, after = text[max(0, start - CONTEXT) : start].lower(), text[end : end + CONTEXT].lower()
    digits = S.only_digits(s)
    groups = re.findall(r"[0-9]+", s)
    year = any(len(g) == 4 and 1900 <= int(g) <= 2030 for g in groups)
    return [
        list(GENERATORS).index(kind),
        len(s),
        len(digits),
        len(groups),
        max(map(len, groups), default=0),
        sum(c.isalpha() for c in s),
        len({c for c in s if not c.isalnum()}),
        float(s.startswith("(")),
        float(tuple(map(len, groups)) in {(3, 3, 4), (3, 4, 4), (2, 4, 4), (4, 3, 3)}),
        float(tuple(map(len, groups)) == (3, 2, 4)),
        float(kind == "iban" and mod97(s)),
        float(year),
        float(kind == "national_id" and digits[:3] not in ("000", "666") and digits[:1] != "9" and digits[3:5] != "00"),
        sum(w in before for w in CUES[kind]),
        sum(w in after for w in CUES[kind]),
        sum(w in before for w in ALL_CUES),
        float(bool(re.search(r"[0-9]", before[-6:]))),
        float(bool(re.search(r"[0-9]", after[:6]))),
        float(bool(re.search(r"[$€£%=]\s*$", before))),
        float(before.rstrip()[-1:] == ":"),
    ]


@dataclass
class Trees:
    """Depth-2 trees of a logistic gradient boosting: (feature, cut) at the root and both children."""

    nodes: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    bias: float
    threshold: float = 0.5

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for f, c, v in zip(self.nodes, self.cuts, self.leaves, strict=True):
            right = x[:, f[0]] > c[0]
            child = np.where(right, x[:, f[2]] > c[2], x[:, f[1]] > c[1])
            z += v[2 * right + child]
        return 1 / (1 + np.exp(-z))


def _best_cut(x: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    best, gain = (0, np.inf), -1.0
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, gs, hs = x[order, f], np.cumsum(g[order]), np.cumsum(h[order])
        at = np.flatnonzero(v[1:] > v[:-1])
        if len(at):
            q = gs[at] ** 2 / (hs[at] + 1) + (gs[-1] - gs[at]) ** 2 / (hs[-1] - hs[at] + 1)
            if q.max() > gain:
                gain, k = q.max(), at[q.argmax()]
                best = (f, float((v[k] + v[k + 1]) / 2))
    return best


def fit_trees(x: np.ndarray, y: np.ndarray, rounds: int = 60, rate: float = 0.3) -> Trees:
    bias = float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    z, nodes, cuts, leaves = np.full(len(y), bias), [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-z))
        g, h = y - p, p * (1 - p)
        f0, c0 = _best_cut(x, g, h)
        right = x[:, f0] > c0
        (f1, c1), (f2, c2) = ((_best_cut(x[m], g[m], h[m]) if m.any() else (0, np.inf)) for m in (~right, right))
        leaf = 2 * right + np.where(right, x[:, f2] > c2, x[:, f1] > c1)
        v = np.array([rate * g[leaf == k].sum() / (h[leaf == k].sum() + 1) for k in range(4)])
        z += v[leaf]
        nodes.append((f0, f1, f2)), cuts.append((c0, c1, c2)), leaves.append(v)
    return Trees(np.array(nodes), np.array(cuts), np.array(leaves), bias)


def _sample(rng: random.Random) -> tuple[str, str, int, int, int]:
    """(text, kind, start, end, label) of one synthetic candidate."""
    word = lambda: "".join(rng.choice("aeioustnrlmdh") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kind, real = rng.choice(list(GENERATORS)), rng.random() < 0.5
    sep = rng.choice(" .-")
    if kind == "spelled_email":
        s = f"{word()}{rng.choice(['.', '', '_'])}{word()} (at) {word()} (dot) com" if real else f"{word()} [at] {d(2)}.{d(1)}"
    elif kind == "local_phone":
        s = rng.choice([f"({d(3)}) {d(3)}-{d(4)}", sep.join((d(3), d(3), d(4))), sep.join((d(2), d(4), d(4)))]) if real else rng.choice([f"{d(2)}.{d(2)}", f"{d(3)} {d(3)}", f"{d(4)}-{d(4)}", f"{d(2)}/{d(2)}", f"{d(3)} {d(2)} {d(5)} {d(3)}"])
    elif kind == "national_id":
        s = f"{rng.randint(101, 665)}-{rng.randint(10, 99)}-{d(4)}" if real else f"{d(3)} {d(2)} {d(4)}"
    elif kind == "iban":
        country, length = rng.choice([("DE", 18), ("CH", 17), ("PT", 21), ("HR", 17)])
        body = d(length)
        check = 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97
        s = f"{country}{check:02d}{body}" if real else f"AB{d(2)}{d(rng.randint(10, 21))}"
        if rng.random() < 0.5:
            s = " ".join(s[k : k + 4] for k in range(0, len(s), 4))
    else:
        s = rng.choice([f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{rng.randint(1930, 2010)}", f"{rng.randint(1930, 2010)}-{rng.randint(10, 12)}-{rng.randint(10, 28)}"]) if real or rng.random() < 0.6 else f"{d(1)}.{d(1)}.{d(2)}"
    cue = rng.choice(CUES[kind]) + rng.choice([": ", " ", " is "]) if real and (kind in ("birth_date", "local_phone", "national_id") or rng.random() < 0.5) else ""
    if real and kind == "local_phone" and s.startswith("(") and rng.random() < 0.3:
        cue = ""
    head = f"{prose(rng.randint(1, 6))} {cue}"
    text = f"{head}{s} {prose(4)}"
    label = int(real)
    return text, kind, len(head), len(head) + len(s), label


def train(rows: int = TRAIN_ROWS, seed: int = SEED, precision: float = PRECISION) -> tuple[Trees, float]:
    """The trees with a threshold that holds `precision` on a calibration third; recall there."""
    rng = random.Random(seed)
    made = [_sample(rng) for _ in range(rows)]
    x = np.array([features(t, k, s, e) for t, k, s, e, _ in made], dtype=float)
    y = np.array([m[4] for m in made], dtype=float)
    cut = rows * 2 // 3
    trees = fit_trees(x[:cut], y[:cut])
    p, truth = trees.score(x[cut:]), y[cut:]
    order = np.argsort(-p, kind="stable")
    exact = np.cumsum(truth[order]) / np.arange(1, len(p) + 1)
    good = np.flatnonzero(exact >= precision)
    trees.threshold = float(p[order[good[-1]]]) if len(good) else 1.0
    return trees, float(((p >= trees.threshold) & (truth == 1)).sum() / max(1, truth.sum()))


def base_spans(text: str) -> list[S.Span]:
    out = S.email_spans(text) if "@" in text else []
    if S.DIGIT.search(text):
        out += S.ip_spans(text) + S.card_spans(text) + S.phone_spans(text)
    return out


def proposed(text: str, kind: str) -> list[S.Span]:
    """What a generator finds; of an IBAN in groups also what ends before its last ones, which may be words."""
    found = [(kind, *m.span()) for m in GENERATORS[kind].finditer(text)]
    if kind == "iban":
        found += [(kind, s, s + k) for _, s, e in found for k in range(15, e - s) if text[s + k] == " "]
    return found


def added_spans(text: str, base: list[S.Span], trees: Trees) -> list[S.Span]:
    found, held = [], S.Taken(base)
    for kind in GENERATORS:
        if kind == "spelled_email" and not ("at)" in text or "at ]" in text or "at]" in text or "at )" in text):
            continue
        found += [f for f in proposed(text, kind) if not held.overlaps(*f[1:])]
    if not found:
        return []
    scores = trees.score(np.array([features(text, *f) for f in found], dtype=float))
    out: list[S.Span] = []
    won = S.Taken()
    for k in np.lexsort((range(len(found)), -scores)):
        if scores[k] >= trees.threshold and not won.overlaps(*found[k][1:]):
            out.append(found[k])
            won.add(*found[k][1:])
    return out


def pii_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: bool = False) -> DataFrame:
    """(id, spans array<struct<kind,start,end,base>>[, redacted]) of every row, over whole texts."""
    small_batches(df.sparkSession)
    trees, _ = train()
    kind = df.schema[id_col].dataType.simpleString()
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))

    def blank(text: str, spans: list[S.Span]) -> str:
        out, at = [], 0
        for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2])):
            if s >= at:
                out += [text[at:s], f"<{k}>"]
            at = max(at, e)
        return "".join(out) + text[at:]

    def run(batches):
        for b in batches:
            found, texts = [], []
            for t in b.column(1).to_pylist():
                base = base_spans(t) if t else []
                more = added_spans(t, base, trees) if t and (S.DIGIT.search(t) or "at" in t) else []
                found.append([{"kind": k, "start": s, "end": e, "base": KINDS[k] < 4} for k, s, e in base + more])
                texts.append(None if t is None or not redact else blank(t, base + more))
            columns = [b.column(0), pa.array(found, kinds)] + [pa.array(texts, pa.string())] * redact
            yield pa.RecordBatch.from_arrays(columns, ["id", "spans", "redacted"][: len(columns)])

    out = df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, f"id {kind}, spans array<struct<kind:string,start:bigint,end:bigint,base:boolean>>" + ", redacted string" * redact)
    return out.withColumnRenamed("id", id_col)
