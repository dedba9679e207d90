"""Words of UTF-8 texts as 64-bit hashes, computed over whole byte arrays at once.

A word is read in lanes of eight bytes; each lane goes through a full avalanche step chained to the
one before, so that no pattern of letters cancels out. Words beyond LONG bytes are hashed by xxhash.
Distinct() numbers the words of a block exactly: equal hashes are compared byte by byte.
"""

from __future__ import annotations

import numpy as np
import xxhash

PIECE, LONG = 1 << 22, 64

#: Bytes of words [0-9a-z] and every non-ASCII character, after A-Z are lower-cased.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
#: Bytes of words [^\x20\x09-\x0D].
VISIBLE = np.ones(256, dtype=bool)
VISIBLE[[0x20, *range(0x09, 0x0E)]] = False
#: Masks that keep the first k bytes of a lane.
KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype="u8")


def mix(h: np.ndarray) -> np.ndarray:
    """A finalizer that spreads all 64 bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of some texts: places in their joined, lower-cased bytes, and words per text."""

    def __init__(self, texts: list[str | bytes | None], word: np.ndarray):
        raw = [(t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass")).lower() if t else b"" for t in texts]
        self.raw = b" ".join(raw)
        starts, ends, at = [np.empty(0, "i8")], [np.empty(0, "i8")], 0
        while at < len(self.raw):
            until = min(at + PIECE, len(self.raw))
            while until < len(self.raw) and word[self.raw[until]]:  # a piece ends where no word goes on
                until += 1
            edge = np.flatnonzero(np.diff(np.concatenate([[False], word[np.frombuffer(self.raw, "u1", until - at, at)], [False]])))
            starts.append(edge[::2] + at), ends.append(edge[1::2] + at)
            at = until
        self.start, self.end = np.concatenate(starts), np.concatenate(ends)
        bounds = np.cumsum([len(r) + 1 for r in raw]) if raw else np.empty(0, "i8")
        self.counts = np.diff(np.searchsorted(self.start, bounds), prepend=0)
        self._lanes = np.ndarray((len(self.raw) + 1,), dtype="<u8", buffer=self.raw + bytes(16), strides=(1,))

    def lane(self, which: np.ndarray, k: int) -> np.ndarray:
        """Eight bytes of words that are longer than 8 * k bytes, zero beyond the end."""
        at = self.start[which] + 8 * k
        return self._lanes[at] & KEEP[np.minimum(self.end[which] - at, 8)]

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]]

    def hashes(self, seed: int = 0) -> np.ndarray:
        length = self.end - self.start
        h = mix(length.astype("u8") * np.uint64(0xD6E8FEB86659FD93) + np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64)))
        which = np.flatnonzero(length <= LONG)
        for k in range(LONG // 8):
            which = which[length[which] > 8 * k]
            if not len(which):
                break
            h[which] = mix(h[which] ^ (self.lane(which, k) + np.uint64(0x9E3779B97F4A7C15)))
        for i in np.flatnonzero(length > LONG).tolist():
            h[i] = xxhash.xxh64_intdigest(self.word(i), seed)
        return h

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether words a[i] and b[i] are equal, byte by byte."""
        length = self.end - self.start
        equal = length[a] == length[b]
        which = np.flatnonzero(equal & (length[a] <= LONG))
        for k in range(LONG // 8):
            which = which[length[a[which]] > 8 * k]
            if not len(which):
                break
            equal[which] &= self.lane(a[which], k) == self.lane(b[which], k)
        for i in np.flatnonzero(equal & (length[a] > LONG)).tolist():
            equal[i] = self.word(a[i]) == self.word(b[i])
        return equal


class Distinct:
    """The distinct words of a block, ordered by hash and then by bytes, and the number of each word."""

    def __init__(self, words: Words, hashes: np.ndarray | None = None):
        h = words.hashes() if hashes is None else hashes
        order = np.argsort(h, kind="stable")
        first = np.concatenate([[True], h[order][1:] != h[order][:-1]]) if len(h) else np.empty(0, bool)
        head, number = order[first], np.empty(len(h), "i8")
        number[order] = np.cumsum(first) - 1
        if len(h) and not words.same(np.arange(len(h)), head[number]).all():  # different words share a hash
            keys = [(x, words.word(i)) for i, x in enumerate(h.tolist())]
            places: dict[tuple, int] = {}
            for i, key in enumerate(keys):
                places.setdefault(key, i)
            head = np.array([places[key] for key in sorted(places)], dtype="i8")
            rank = {key: k for k, key in enumerate(sorted(places))}
            number = np.array([rank[key] for key in keys], dtype="i8")
        self.terms, self.number = h[head], number
        self.strings = [words.word(i) for i in head.tolist()]


def matched(terms: np.ndarray, strings: list[bytes], known: np.ndarray, known_strings: list[bytes]) -> np.ndarray:
    """The place of each term among the known ones (sorted by hash), confirmed by its bytes; -1 where there is none."""
    out = np.full(len(terms), -1, dtype="i8")
    if not len(known):
        return out
    at = np.searchsorted(known, terms)
    for i in np.flatnonzero(known[np.minimum(at, len(known) - 1)] == terms).tolist():
        k = int(at[i])
        while k < len(known) and known[k] == terms[i]:
            if known_strings[k] == strings[i]:
                out[i] = k
                break
            k += 1
    return out


def block_words(texts: list[str | None], word: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, words per text) over many texts at once."""
    words = Words(texts, word)
    return words.hashes(seed), words.counts
