"""Encoding and decoding with the pieces of a sentencepiece model of merges.

The model merges neighbours, best score first, until no two make a piece.  Its result is
the one sequence of pieces in which every two neighbours stay as they are when they are
merged anew on their own.  So a text is read from the left, the longest piece first.  All
pieces are found by an Aho-Corasick automaton in one pass.  A piece that does not go with the
one before, or that ends where nothing goes on, gives way to the longest piece that it
begins with; where there is none, the piece before is taken back and the place marked as
failed, one bit each.  Every place fails once at most, so time grows with the text.

Characters without a piece are written as bytes.  White space is a visible mark before the
word; no piece goes on behind a word, so words are encoded one by one and those met before
are remembered.
"""

from __future__ import annotations

import re
from array import array
from functools import cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import bounded_batches

# How white space is written in pieces.
MARK = "▁"

# Rows handed to Python at once.
BATCH_ROWS = 200

# A worker's memory of words and of pairs of pieces.
WORDS, PAIRS = 1_000_000, 500_000

# Ids handed on at once; a longer text goes alone.
CHUNK_IDS = 1 << 21

# Longer words are not remembered.
WORD_CHARS = 64

# No piece.
NONE = -1


class _Memory(dict):
    """Results of a function by argument: the last ``size / 2`` new ones at least, ``size`` at most."""

    def __init__(self, function, size: int, kept=lambda key: True):
        self.function, self.half, self.older, self.kept = function, size // 2, {}, kept

    def __missing__(self, key):
        if not self.kept(key):
            return self.function(key)
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceEncoder:
    """Encoder of a model whose pieces are merged, with bytes for characters it does not know."""

    def __init__(self, model_file: str):
        import ahocorasick
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        _require_plain(self.model)
        m = self.model
        special = lambda i: m.is_unknown(i) or m.is_control(i) or m.is_byte(i)
        self.ids = {m.id_to_piece(i): i for i in range(m.get_piece_size()) if not special(i)}
        self.scores = {piece: m.get_score(i) for piece, i in self.ids.items()}
        self.byte_ids = [m.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(re.search(f"[^{MARK}]{MARK}", piece) for piece in self.ids):
            raise ValueError("a piece goes on behind a word")
        if any(c not in self.ids for piece in self.ids for c in piece):
            raise ValueError("a piece holds a character that is none")
        self.pieces = [m.id_to_piece(i) for i in range(m.get_piece_size())]
        self.sizes = [len(piece) for piece in self.pieces]
        self.characters = {piece: i for piece, i in self.ids.items() if len(piece) == 1}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            # One that merges do not lead to is never part of a result; characters are looked up.
            if len(piece) > 1 and self.merged(piece) == [piece]:
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        # The longest shorter piece that each begins with.
        self.shorter = [NONE] * len(self.pieces)
        for piece, i in self.ids.items():
            begins = (piece[:k] for k in range(len(piece) - 1, 0, -1))
            self.shorter[i] = next((self.ids[head] for head in begins if len(head) == 1 or head in self.automaton), NONE)
        self.pairs = _Memory(self._goes_together, PAIRS)
        self.words = _Memory(self._word_ids, WORDS, lambda word: len(word) <= WORD_CHARS)
        self._cut = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")

    def merged(self, text: str) -> list[str]:
        """The parts of a short text after all merges; of equal scores the first pair merges first."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _goes_together(self, pair: int) -> bool:
        left, right = (self.pieces[i] for i in divmod(pair, len(self.pieces)))
        return self.merged(left + right) == [left, right]

    def _word_ids(self, word: str) -> bytes:
        sizes, shorter, pairs, total = self.sizes, self.shorter, self.pairs, len(self.pieces)
        n = len(word)
        longest = [*map(self.characters.get, word, repeat(NONE, n))]
        for end, piece in self.automaton.iter(word):
            # Of pieces that begin at one place the longer ones end later.
            longest[end + 1 - sizes[piece]] = piece
        out: list[int] = []  # ids, and characters without a piece as numbers below NONE
        failed = unknown = None
        at, last, piece = 0, NONE, longest[0]
        while True:
            while piece >= 0:
                end = at + sizes[piece]
                if (last < 0 or pairs[last * total + piece]) and not (failed and failed[end >> 3] >> (end & 7) & 1):
                    break
                piece = shorter[piece]
            if piece >= 0:
                out.append(piece)
                at, last = end, piece
            elif longest[at] == NONE:
                # Nothing merges with a character that no piece holds.
                out.append(NONE - 1 - ord(word[at]))
                at, last, unknown = at + 1, NONE, True
            else:
                failed = failed or bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                taken = out.pop()
                at -= sizes[taken]
                last = out[-1] if out else NONE
                piece = shorter[taken]
                continue
            if at == n:
                return self._with_bytes(out) if unknown else array("i", out).tobytes()
            piece = longest[at]

    def _with_bytes(self, found: list[int]) -> bytes:
        ids = array("i")
        for i in found:
            if i >= 0:
                ids.append(i)
            else:
                ids.extend(self.byte_ids[b] for b in chr(NONE - 1 - i).encode())
        return ids.tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.int32)
        words = self._cut.findall(MARK + text.replace(" ", MARK))
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), dtype=np.int32)


def _require_plain(model) -> None:
    """The model must take texts as they are: only spaces change, and one is put before."""
    for probe in (" a  b\t\n ", "ééﬁＡ　\x00", MARK):
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError("model that normalises texts")


@cache
def encoder(model_file: str) -> PieceEncoder:
    """One encoder per worker and model."""
    return PieceEncoder(model_file)


def encode_documents(
    docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", out: str = "ids"
) -> DataFrame:
    """``doc_id`` and the token ids of every row, without begin, end or sampling.

    ``model_file`` must be readable on every worker.  NULL counts as empty and has no ids;
    white space has some.  Texts are encoded whole, however long.  Repeated rows and NULL ids
    stay as they are; no rows give no rows.
    """
    bounded_batches(docs.sparkSession, BATCH_ROWS)
    kind = docs.schema[id_col].dataType.simpleString()
    most = CHUNK_IDS

    def rows(batches):
        for batch in batches:
            own, found, begin, held = encoder(model_file), [], 0, 0
            for row, text in enumerate(batch.column("text"), 1):
                found.append(own.encode(text.as_py() or ""))
                held += len(found[-1])
                if held < most and row < batch.num_rows:
                    continue
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(begin, len(found)), ids], ["id", "ids"])
                found, begin, held = [], row, 0

    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = narrow.mapInArrow(rows, f"id {kind}, ids array<int>")
    return found.select(F.col("id").alias(id_col), F.col("ids").alias(out))


def decode_documents(encoded: DataFrame, model_file: str, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """``encoded`` with the column of ids replaced by the text that the model decodes them to.

    NULL or no ids give an empty text.  All other columns stay.
    """
    others = [c for c in encoded.columns if c != ids_col]
    kinds = ", ".join(f"c{i} {encoded.schema[c].dataType.simpleString()}" for i, c in enumerate(others))

    def rows(batches):
        for batch in batches:
            model = encoder(model_file).model
            texts = [model.decode(ids.as_py()) if ids.is_valid and len(ids) else "" for ids in batch.column("ids")]
            own = [batch.column(f"c{i}") for i in range(len(others))]
            yield pa.RecordBatch.from_arrays([*own, pa.array(texts, pa.string())], [*[f"c{i}" for i in range(len(own))], "text"])

    narrow = encoded.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.col(ids_col).alias("ids"))
    found = narrow.mapInArrow(rows, f"{kinds}{', ' if kinds else ''}text string")
    return found.toDF(*others, out)
