"""Words, lines and their hashes for a whole Arrow array of texts at once.

A word is a run of bytes other than space and 0x09-0x0D; in UTF-8 these are single
bytes, so words are found without decoding.  Hashes have 64 bits: a sum over the
bytes of random values times powers of an odd number, which turns the hash of any
stretch into a difference of two running sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Texts are taken in slices of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15
SYMBOLS = b"#*$%&|<>"


def _flags(chars: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(chars)] = True
    return table


_SPACE = _flags(b" \t\n\x0b\x0c\r")
_SYMBOL = _flags(SYMBOLS)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * _U64(2) + _U64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finisher of a known generator, see README)."""
    h = (h ^ (h >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U64(27))) * _U64(0x94D049BB133111EB)
    return h ^ (h >> _U64(31))


def _powers(n: int, base: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        steps = np.full(n + 1, base, dtype=np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)


@dataclass
class Texts:
    """Bytes of several texts; text ``i`` is ``data[offsets[i]:offsets[i + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    def __post_init__(self):
        self._sums = self._inverse = None

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def lower(self) -> "Texts":
        """A-Z in lower case, all else as it is."""
        return Texts(_LOWER[self.data], self.offsets)

    def text_of(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def _first(self) -> np.ndarray:
        first = np.zeros(len(self.data) + 1, dtype=bool)
        first[self.offsets] = True
        return first

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of marked bytes; a run ends with its text."""
        if not len(self.data):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        first = self._first()
        before = np.concatenate(([False], inside[:-1]))
        after = np.concatenate((inside[1:], [False]))
        starts = np.flatnonzero(inside & (~before | first[:-1]))
        ends = np.flatnonzero(inside & (~after | first[1:])) + 1
        return starts, ends

    def words(self) -> tuple[np.ndarray, np.ndarray]:
        return self.runs(~_SPACE[self.data])

    def lines(self) -> tuple[np.ndarray, np.ndarray]:
        """Non-empty lines between line feeds."""
        return self.runs(self.data != 10)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self._sums is None:
            n = len(self.data)
            self._sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_VALUES[self.data] * _powers(n, _BASE)[:n], out=self._sums[1:])
            self._inverse = _powers(n, pow(_BASE, -1, 1 << 64))
        h = (self._sums[ends] - self._sums[starts]) * self._inverse[starts]
        return mix(h + (ends - starts).astype(np.uint64) * _U64(0xD6E8FEB86659FD93))

    def count(self, marked: np.ndarray) -> np.ndarray:
        """Marked bytes of each text."""
        sums = np.concatenate(([0], np.cumsum(marked, dtype=np.int64)))
        return sums[self.offsets[1:]] - sums[self.offsets[:-1]]


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts in order, in slices of bounded size.  NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    texts = texts.fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < len(texts):
        end = int(np.searchsorted(offsets, offsets[begin] + limit, side="right")) - 1
        end = min(max(end, begin + 1), len(texts))
        yield Texts(data[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin])
        begin = end


def equal_runs(owner: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order by owner and key, and whether each entry in it equals the one before."""
    order = np.lexsort((keys, owner))
    o, k = owner[order], keys[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (o[1:] == o[:-1]) & (k[1:] == k[:-1])
    return order, same


def windows(h: np.ndarray, owner: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first index of every window of ``width`` neighbours with one owner."""
    last = len(h) - width + 1
    if last <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(owner[:last] == owner[width - 1 :])
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(width):
        total = mix(total * _U64(_BASE) + h[at + i])
    return total, at


def text_stats(t: Texts) -> dict[str, np.ndarray]:
    """Counts of each text that quality rules and scores use."""
    n = len(t)
    starts, ends = t.words()
    owner = t.text_of(starts)
    per = lambda at: np.bincount(at, minlength=n).astype(np.int64)
    h = t.hashes(starts, ends)
    in_word = ~_SPACE[t.data]
    out = {
        "n_bytes": np.diff(t.offsets),
        "n_words": per(owner),
        "word_chars": t.count(in_word & ((t.data & 0xC0) != 0x80)),
        "n_symbols": t.count(_SYMBOL[t.data]),
        "n_upper": t.count((t.data >= 65) & (t.data <= 90)),
        "n_lower": t.count((t.data >= 97) & (t.data <= 122)),
        "n_digits": t.count((t.data >= 48) & (t.data <= 57)),
        "n_bangs": t.count((t.data == 33) | (t.data == 63)),
        "n_stops": t.count((t.data == 46) | (t.data == 44)),
    }

    # Lines with a word, and those equal to an earlier one.
    ls, le = t.lines()
    words_before = np.searchsorted(starts, ls), np.searchsorted(starts, le)
    full = words_before[0] < words_before[1]
    ls, le = ls[full], le[full]
    line_owner = t.text_of(ls)
    order, same = equal_runs(line_owner, t.hashes(ls, le))
    out["n_lines"] = per(line_owner)
    out["n_dup_lines"] = per(line_owner[order[same]])

    # Distinct words, the most frequent one, words equal to the one before.
    order, same = equal_runs(owner, h)
    out["n_distinct"] = out["n_words"] - per(owner[order[same]])
    heads = np.flatnonzero(~same)
    counts = np.diff(np.append(heads, len(same)))
    top = np.zeros(n, dtype=np.int64)
    if len(heads):
        np.maximum.at(top, owner[order[heads]], counts)
    out["n_top"] = top
    again = np.zeros(len(h), dtype=bool)
    again[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    out["n_echo"] = per(owner[again])
    out["n_short"] = per(owner[(ends - starts) == 1])

    # Words in three-word windows that occur twice or more.
    grams, at = windows(h, owner, 3)
    order, same = equal_runs(owner[at], grams)
    twice = same.copy()
    twice[:-1] |= same[1:]
    hit = at[order[twice]]
    covered = np.zeros(len(h) + 2, dtype=bool)
    for i in range(3):
        covered[hit + i] = True
    out["n_repeat_words"] = per(owner[covered[: len(h)]])
    return out
