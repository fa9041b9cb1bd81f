"""Pieces of the sentencepiece model and fill-in-the-middle."""

from __future__ import annotations

import hashlib
import random
import re

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from coffer.llm import infill, pieces, queries
from coffer.llm.words import slices

from .conftest import ODD

MODEL = public_tokenizers.path("piece_bpe_32k.model")

# Letters of the model's words, marks, characters without a piece, white space of all kinds.
LETTERS = "  ▁aeioutnrsthldéàü漢字ァ𝄞\U000e0041\x00\t\n\r　ABC.,019<>/s'"

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_ids_are_those_of_the_library(library):
    own, rng = pieces.encoder(MODEL), random.Random(4)
    for most in (8, 60, 500):
        for _ in range(1500):
            text = "".join(rng.choice(LETTERS) for _ in range(rng.randrange(most)))
            assert own.encode(text).tolist() == library.encode(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_ids_of_any_text(text):
    own = pieces.encoder(MODEL)
    assert own.encode(text).tolist() == own.model.encode(text)


@pytest.mark.parametrize(
    "text",
    ["a" * 60_000, " " * 60_001, "ab" * 30_000, "the" * 20_000 + " " * 37 + "x", "\n" * 3000, "漢" * 9000, "aaab" * 4000 + "▁" * 33, "𝄞" * 500],
    ids=lambda t: t[:4],
)
def test_long_runs(library, text):
    """Longer than a word that is remembered, and full of places to fail at."""
    assert pieces.encoder(MODEL).encode(text).tolist() == library.encode(text)


def test_all_pieces_are_reached_from_themselves_or_left_out(library):
    own = pieces.encoder(MODEL)
    for piece in own.ids:
        assert (own.merged(piece) == [piece]) == (len(piece) == 1 or piece in own.automaton)


def test_memory_is_bounded():
    calls = []
    memory = pieces._Memory(lambda k: calls.append(k) or k * 2, 10)
    for k in [*range(100), *range(95, 100)]:
        assert memory[k] == 2 * k and len(memory) + len(memory.older) <= 10
    assert len(calls) == 100


@pytest.mark.parametrize("chunk", [1, 50, 1 << 21])
def test_encode_and_decode_documents(spark, documents, library, tmp_path, monkeypatch, chunk):
    monkeypatch.setattr(pieces, "CHUNK_IDS", chunk)
    rows = [*ODD, (1, "<s> </s> <unk> <0x41>", "en", "s"), (2, "▁▁a ▁", "en", "s"), (3, "tail \n", None, None)]
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    found = sorted(map(tuple, queries.op11_pieces(spark, str(tmp_path)).collect()), key=repr)
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "")
        want.append((doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids) if ids else "")))
    assert found == sorted(want, key=repr)
    assert queries.op11_pieces(spark, f"{tmp_path}/none").count() == 0
    back = pieces.decode_documents(pieces.encode_documents(docs, MODEL).withColumn("c0", F.lit(7)), MODEL)
    assert back.columns == ["doc_id", "c0", "text"]
    lost = {r[0]: r["text"] for r in back.collect()}
    assert lost[9005] == "été naïve 漢字 текст" and lost[9001] == ""


def test_a_model_that_normalises_is_refused():
    class Folding:
        def normalize(self, text):
            return "▁" + text.strip().replace(" ", "▁")

    with pytest.raises(ValueError):
        pieces._require_plain(Folding())


def test_units_and_characters():
    rng = random.Random(5)
    letters = " \t\n\x0b\x0c\r\x08\x0e\x1f!ab\x00é漢𝄞\xa0 \x7f"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(2000)]
    texts += ["", " ", "a", " " * 8, "a" * 8, "a" * 7 + " ", "a" * 16 + " " * 16, "é" * 4]
    done = 0
    for t in slices(pa.array(texts), 3000):
        own, units = texts[done : done + len(t)], infill.Units(t)
        done += len(t)
        split = [UNIT.findall(x) for x in own]
        assert units.counts.tolist() == [len(s) for s in split]
        for number in (lambda s: 0, len, lambda s: rng.randint(0, len(s))):
            wanted = [number(s) for s in split]
            ends = units.end_of(pa.array(wanted).to_numpy())
            heads = ["".join(s[:k]) for s, k in zip(split, wanted)]
            assert ends.tolist() == [len(h.encode()) for h in heads]
            assert units.chars_to(ends).tolist() == [len(h) for h in heads]


def by_hand(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    hexed = digest(f"42:{'' if doc_id is None else doc_id}")
    h = [int(hexed[i : i + 8], 16) for i in range(0, 32, 8)]
    low, high = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = ("".join(units[a:b]) for a, b in ((0, low), (low, high), (high, None)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infilled_documents(spark, documents, tmp_path):
    rng = random.Random(6)
    rows = [(i, "".join(rng.choice("ab é漢𝄞 \n\t<PSM>") for _ in range(rng.randrange(60))), "en", "s") for i in range(300)]
    rows += [*ODD, (400, "a <P> b", "en", "s"), (401, "<S", "en", "s"), (402, "<M> " * 9, None, None)]
    docs = documents(rows)
    want = sorted((by_hand(i, t) for i, t, *_ in rows), key=repr)
    assert sorted(map(tuple, infill.infilled(docs).collect()), key=repr) == want
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    digests = sorted(map(tuple, queries.op12_infill(spark, str(tmp_path)).collect()), key=repr)
    texts = {(i, digest(by_hand(i, t)[5])): digest(t or "") for i, t, *_ in rows}
    assert [d[:5] for d in digests] == [w[:5] for w in want]
    assert all(texts[d[0], d[5]] == d[6] for d in digests)
    assert infill.infilled(documents([])).count() == 0
    other = infill.infilled(docs, seed=7, cut_percent=100, suffix_first_percent=0)
    assert {r["form"] for r in other.collect()} == {"plain", "psm"}
