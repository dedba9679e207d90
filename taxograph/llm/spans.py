"""Spans of texts: base detectors for secrets and personal data, and their digest columns.

A span is (kind, start, end) in code points, end exclusive. All scanners take linear time: a start
that fails is never tried again inside the same run of characters.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

Span = tuple[str, int, int]


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


ASSIGN = re.compile(
    "(?:" + "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
DIGIT = re.compile(r"[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def assign_spans(text: str) -> list[Span]:
    return [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= 6]


def access_spans(text: str) -> list[Span]:
    return [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]


def hex_spans(text: str) -> list[Span]:
    return [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def email_spans(text: str) -> list[Span]:
    """From each @ to the left as far as the local part goes, and to the right over the domain."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > done and text[left - 1] in LOCAL:
            left -= 1
        if left < at and (m := DOMAIN.match(text, at + 1)):
            out.append(("email", left, m.end()))
            done = m.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(at + 1, done))
    return out


def ip_spans(text: str) -> list[Span]:
    return [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(len(q := p.lstrip("0")) <= 3 and int(q or 0) <= 255 for p in m.groups())]


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = ord(d) - 48
        total += v if k % 2 == 0 else v * 2 - 9 * (v > 4)
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def card_spans(text: str) -> list[Span]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() <= 40 and 12 <= len(d := only_digits(m[0])) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    return out


def phone_spans(text: str) -> list[Span]:
    return [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(only_digits(m[0])) <= 15] if "+" in text else []


def joined(spans: list[Span], kinds: dict[str, int]) -> str:
    """kind:start:end by start, then by kind as listed, then by end."""
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], kinds[x[0]], x[2])))


def digest(base: list[Span], kinds: dict[str, int]) -> str:
    return hashlib.sha256(joined(base, kinds).encode()).hexdigest()


class Taken:
    """Places of a text that spans hold; each question and each addition searches once."""

    def __init__(self, spans: list[Span] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, s, e in sorted(spans, key=lambda x: x[1:]):
            if self.ends and s <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], e)
            else:
                self.starts.append(s), self.ends.append(e)

    def overlaps(self, start: int, end: int) -> bool:
        k = bisect_left(self.starts, end)
        return k > 0 and self.ends[k - 1] > start

    def add(self, start: int, end: int) -> None:
        """Add a span that overlaps none so far."""
        k = bisect_left(self.starts, end)
        self.starts.insert(k, start), self.ends.insert(k, end)
