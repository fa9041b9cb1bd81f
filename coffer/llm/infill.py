"""Fill-in-the-middle: texts cut into prefix, middle and suffix at the ends of their units.

A unit is a word with the white space before it, or the white space that ends a text.
Units are found without decoding: the UTF-8 bytes of many texts, each padded with spaces to
whole words of eight bytes, are viewed as uint64.  Arithmetic on such a word marks all of
its bytes that are white space at once, and from them the bytes that end a unit.  Bit
counts per word and their running sum lead to the word that holds the unit looked for; the
byte in it follows from running counts within the word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import bounded_batches
from coffer.llm.words import Texts, slices

SEED = 42

# Of a hundred texts so many are cut, and of a hundred cut ones so many start with the suffix.
CUT_PERCENT, SUFFIX_FIRST_PERCENT = 50, 80

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

# Rows handed to Python at once: an output is as long as its text.
BATCH_ROWS = 200

_U64 = np.uint64
_ONES = _U64(0x0101010101010101)
_HIGH = _U64(0x8080808080808080)
_LOW = _U64(0x7F7F7F7F7F7F7F7F)


def _at_least(low: np.ndarray, k: int) -> np.ndarray:
    """High bit of each byte of which the low seven bits are ``k`` or more."""
    return (low + _ONES * _U64(128 - k)) & _HIGH


def white_bytes(words: np.ndarray) -> np.ndarray:
    """High bit of each byte that is 0x20 or 0x09 to 0x0D."""
    low = words & _LOW
    white = (_at_least(low, 0x09) ^ _at_least(low, 0x0E)) | (_at_least(low, 0x20) ^ _at_least(low, 0x21))
    return white & ~words


def first_bytes(words: np.ndarray) -> np.ndarray:
    """High bit of each byte that starts a code point."""
    return ~(words & ~(words << _U64(1))) & _HIGH


class Units:
    """Units of several texts, found by the number of the unit.

    ``at[i]`` is the word in which text ``i`` begins.  ``counts`` has the units of each text.
    """

    def __init__(self, texts: Texts):
        sizes = np.diff(texts.offsets)
        self.at = np.concatenate(([0], np.cumsum(sizes // 8 + 1)))
        data = np.full(self.at[-1] * 8, 0x20, dtype=np.uint8)
        shift = np.repeat(self.at[:-1] * 8 - texts.offsets[:-1], sizes)
        data[np.arange(len(texts.data)) + shift] = texts.data
        self.words = data.view("<u8")
        white = white_bytes(self.words)
        following = np.zeros_like(white)
        following[:-1] = white[1:]
        # A unit ends where white space follows on something else; padding ends the last word.
        self.ends = ~white & _HIGH & ((white >> _U64(8)) | (following << _U64(56)))
        # White space at the end of a text is a unit of its own.
        some = np.flatnonzero(sizes)
        last = self.at[:-1][some] * 8 + sizes[some] - 1
        self.ends[last >> 3] |= white[last >> 3] & (_U64(0x80) << ((last & 7) * 8).astype(np.uint64))
        self._before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.ends), dtype=np.int64)))
        self.counts = self._before[self.at[1:]] - self._before[self.at[:-1]]
        firsts = first_bytes(self.words)
        self._firsts = firsts
        self._chars = np.concatenate(([0], np.cumsum(np.bitwise_count(firsts), dtype=np.int64)))

    def end_of(self, unit: np.ndarray) -> np.ndarray:
        """Bytes of each text up to the end of its ``unit``-th unit; 0 for none."""
        wanted = self._before[self.at[:-1]] + unit
        word = np.searchsorted(self._before, wanted, side="left") - 1
        word = np.where(unit > 0, word, self.at[:-1])
        rank = wanted - self._before[word]
        # Byte by byte the ends so far; those that reach the rank begin at the byte looked for.
        running = (self.ends[word] >> _U64(7)) * _ONES
        reached = (running + (_U64(128) - rank.astype(np.uint64)) * _ONES) & _HIGH
        byte = 8 - np.bitwise_count(reached).astype(np.int64)
        return np.where(unit > 0, word * 8 + byte + 1 - self.at[:-1] * 8, 0)

    def chars_to(self, end: np.ndarray) -> np.ndarray:
        """Code points in the first ``end`` bytes of each text."""
        word, byte = self.at[:-1] + (end >> 3), (end & 7).astype(np.uint64)
        below = (_U64(1) << (byte * _U64(8))) - _U64(1)
        return self._chars[word] + np.bitwise_count(self._firsts[word] & below) - self._chars[self.at[:-1]]


def draws(key: Column, seed: int = SEED) -> list[Column]:
    """Four numbers below 2**32 from the digest of the seed and the key; a NULL key counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("bigint") for i in range(4)]


def _shapes(data: bytes, units: Units, h: list[np.ndarray], offsets: np.ndarray, cut: int, suffix_first: int):
    """Columns of the result for one slice of texts."""
    n = units.counts
    first, second = h[0] % (n + 1), h[1] % (n + 1)
    low, high = units.end_of(np.minimum(first, second)), units.end_of(np.maximum(first, second))
    low_chars, high_chars = units.chars_to(low), units.chars_to(high)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    forms, prefixes, middles, out = [], [], [], []
    for i in range(len(n)):
        text = data[offsets[i] : offsets[i + 1]]
        if not text or h[2][i] % 100 >= cut or any(m in text for m in marks):
            forms.append("plain")
            prefixes.append(None)
            middles.append(None)
            out.append(text)
            continue
        prefix, middle, suffix = text[: low[i]], text[low[i] : high[i]], text[high[i] :]
        p, s, m = marks
        spm = h[3][i] % 100 < suffix_first
        forms.append("spm" if spm else "psm")
        prefixes.append(int(low_chars[i]))
        middles.append(int(high_chars[i] - low_chars[i]))
        out.append(b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle)))
    return n, forms, prefixes, middles, out


def infilled(
    docs: DataFrame,
    seed: int = SEED,
    cut_percent: int = CUT_PERCENT,
    suffix_first_percent: int = SUFFIX_FIRST_PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n`` units, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    The middle lies between the ends of two units that the digest of ``seed`` and the id
    chooses; either may be empty, as may prefix and suffix.  ``form`` is ``plain`` (the text
    as it is), ``psm`` or ``spm``.  NULL counts as empty; an empty text is plain and has no
    units, one of white space has one.  A text that holds a mark stays plain.  NULL ids draw
    as an empty id; rows that share an id share their draws, and equal rows come out equal.
    Texts are never shortened: one of any length that Spark can hold is cut whole.
    """
    bounded_batches(docs.sparkSession, BATCH_ROWS)
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(batches):
        for batch in batches:
            h = [batch.column(f"h{i}").to_numpy() for i in range(1, 5)]
            done = 0
            for t in slices(batch.column("text")):
                here = slice(done, done + len(t))
                found = _shapes(
                    t.data.tobytes(), Units(t), [x[here] for x in h], t.offsets, cut_percent, suffix_first_percent
                )
                n, forms, prefixes, middles, out = found
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(done, len(t)),
                        pa.array(n),
                        pa.array(forms, pa.string()),
                        pa.array(prefixes, pa.int64()),
                        pa.array(middles, pa.int64()),
                        pa.array(out, pa.binary()).cast(pa.string()),
                    ],
                    ["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )
                done += len(t)

    h = [c.alias(f"h{i}") for i, c in enumerate(draws(F.col(id_col), seed), 1)]
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *h)
    found = narrow.mapInArrow(
        rows, f"id {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"
    )
    return found.withColumnRenamed("id", id_col)


def restored(form: Column, output: Column) -> Column:
    """The text from which an output was made."""
    part = F.split(output, "<[PSM]>", -1)
    whole = lambda *order: F.concat(*[F.element_at(part, i + 1) for i in order])
    return F.when(form == "psm", whole(1, 3, 2)).when(form == "spm", whole(2, 3, 1)).otherwise(output)
