"""Mixing, packing, sharding and the pipeline."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from coffer.llm import mixing, packing, queries, sharding

from .conftest import ODD, prose, words


def targets_by_rounds(sizes):
    """Targets by sharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    target, free, left = {}, set(order), float(sum(sizes.values()))
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * sizes[s] + 1e-9}
        if not over:
            return target | {s: level * weight[s] for s in free}
        for s in over:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        free -= over


def test_mixing(documents):
    rng = np.random.default_rng(1)
    rows = []
    for source, n in (("a", 900), ("b", 60), ("c", 5), ("d", 200), ("é", 2), (None, 30), ("z", 400)):
        rows += [(len(rows) + k, prose(rng, int(rng.integers(1, 60))), "en", source) for k in range(n)]
    rows += [r for r in ODD if r[0] not in (9006, 9009)]
    got = mixing.mixed_documents(documents(rows)).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(words(text))
    target = targets_by_rounds(sizes)
    source_of = {r[0]: r[3] for r in rows if r[0] is not None}
    taken, by_id = Counter(), defaultdict(set)
    for r in got:
        if r["doc_id"] is not None:
            source = source_of[r["doc_id"]]
            assert r["source_size"] == sizes[source]
            assert r["target"] == pytest.approx(target[source])
        else:
            source = "src1"
        taken[source] += r["taken"]
        assert r["size"] == 0 or r["taken"] % r["size"] == 0
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_id[r["doc_id"]].add(tuple(r))
    for source, words_wanted in target.items():
        assert abs(taken[source] - words_wanted) <= 30, source
    again = mixing.mixed_documents(documents(rows[::-1]).repartition(3)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mixing_of_one_source_takes_all_once(documents):
    rows = [(i, f"word {i}", "en", "only") for i in range(20)]
    assert all(r["taken"] == r["size"] == 2 for r in mixing.mixed_documents(documents(rows)).collect())
    assert mixing.mixed_documents(documents([])).count() == 0
    empty = mixing.mixed_documents(documents([(1, None, None, None), (2, "", "en", "a")])).collect()
    assert all(r["taken"] == 0 and r["target"] == 0 for r in empty)


@pytest.mark.parametrize("ident", [None, 7])
@pytest.mark.parametrize("texts", ["equal", "different"])
def test_mixing_of_rows_that_share_an_id(documents, ident, texts):
    """A source of 1,000 rows under one id ends within one document of its target."""
    rng = np.random.default_rng(3)
    text = lambda i: prose(rng, 10) if texts == "different" else "one two three four five six seven eight nine ten"
    rows = [(ident, text(i), "en", "a") for i in range(1000)] + [(10_000 + i, prose(rng, 10), "en", "b") for i in range(1000)]
    docs = documents(rows)
    got = mixing.mixed_documents(docs).collect()
    taken = sum(r["taken"] for r in got if r["doc_id"] == ident)
    assert got[0]["target"] and abs(taken - 20_000 / 3) <= 10
    assert abs(sum(r["taken"] for r in got) - 20_000) <= 20
    again = mixing.mixed_documents(docs.repartition(7)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert abs(mixing.repeated(docs).filter(F.col("doc_id").eqNullSafe(F.lit(ident))).count() - 2000 / 3) <= 1


def test_chances_add_up_to_what_is_wanted(spark):
    rng = np.random.default_rng(6)
    rows = [(key, int(size)) for key, n in (("sa", 400), ("sb", 3), ("sc", 1)) for size in rng.lognormal(4, 1.5, n) + 1]
    frame = spark.createDataFrame([*rows, ("sa", 0), ("sd", 0)], "key string, size bigint")
    totals = Counter()
    for key, size in rows:
        totals[key] += size
    share = {"sa": 0.3, "sb": 0.9, "sc": 0.01, "sd": 0.5}
    sampled = spark.createDataFrame([(k, s, totals[k]) for k, s in share.items()], "key string, share double, source_size bigint")
    factor = {r["key"]: r["factor"] for r in mixing.odds_factors(frame, sampled).collect()}
    assert set(factor) == {"sa", "sb", "sc"}
    for key, f in factor.items():
        odds = [(size, f * 2 ** (size.bit_length() / 2)) for k, size in rows if k == key]
        assert sum(size * o / (1 + o) for size, o in odds) == pytest.approx(share[key] * totals[key])


def test_documents_are_taken_as_often_as_the_design_says(documents):
    """Over seeds, the share of draws in which a document is taken is its chance."""
    rng = np.random.default_rng(8)
    sizes = [4] * 30 + [30] * 20 + [200] * 10
    rows = [(i, prose(rng, n), "en", "a") for i, n in enumerate(sizes)] + [(100 + i, prose(rng, 40), "en", "b") for i in range(60)]
    narrow = documents(rows).select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), mixing.draw_key("doc_id", F.col("text")).alias("__draw"))
    size, draw = F.col("size"), F.col("__draw")
    hits, seeds = Counter(), 12
    for seed in range(seeds):
        plan = mixing.mixture(narrow, size, draw, seed=f"s{seed}")
        for r in mixing.with_copies(narrow, plan, size, draw, seed=f"s{seed}").filter("source = 'a'").collect():
            hits[r["size"]] += r["copies"] - r["copies_plan"]["whole"]
            factor = r["copies_plan"]["factor"]
    for n, many in ((4, 30), (30, 20), (200, 10)):
        odds = factor * 2 ** (n.bit_length() / 2)
        assert hits[n] / (many * seeds) == pytest.approx(odds / (1 + odds), abs=0.11)


def test_inclusion_follows_the_odds(documents):
    """Of two sizes in one source the larger is taken more often, as the odds say."""
    rows = [(i, prose(np.random.default_rng(i), 3 if i % 2 else 48), "en", "a") for i in range(3000)]
    rows += [(10_000 + i, prose(np.random.default_rng(i), 30), "en", "b") for i in range(3000)]
    got = [r for r in mixing.mixed_documents(documents(rows)).collect() if r["doc_id"] < 10_000]
    shares = [np.mean([r["taken"] % (2 * r["size"]) > 0 for r in got if r["size"] == s]) for s in (3, 48)]
    odds = [p / (1 - p) for p in shares]
    assert odds[1] / odds[0] == pytest.approx(np.sqrt(49 / 4), rel=0.35)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 90), max_size=40))
def test_pack(sizes):
    pieces = packing.pack(sizes, 16)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, length, sequence, offset in pieces:
        by_doc[doc].append((start, length))
        by_sequence[sequence].append((offset, length))
    for doc, size in enumerate(sizes):
        at = 0
        for start, length in sorted(by_doc[doc]):
            assert start == at and length > 0
            at += length
        assert at == size
    used = []
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 16
        used.append(at)
    assert sorted(by_sequence) == list(range(-(-sum(sizes) // 16)))
    assert sum(u < 16 for u in used) <= 1


def cheapest_with_room(sizes, length):
    """The sequence of each uncut piece by plain search, for sizes below the length."""
    n = -(-sum(sizes) // length)
    room, spent, out = [length] * n, [0.0] * n, {}
    room[-1] = sum(sizes) - (n - 1) * length
    for doc in sorted(range(len(sizes)), key=lambda d: (-sizes[d], d)):
        size, start = sizes[doc], 0
        open_to = [i for i in range(n) if room[i] >= size]
        while size:
            i = min(open_to or [i for i in range(n) if room[i]], key=lambda i: (spent[i], i))
            part = min(size, room[i])
            out[doc, start] = (part, i)
            room[i], spent[i], start, size = room[i] - part, spent[i] + packing.cost(part), start + part, size - part
    return out


@pytest.mark.parametrize("seed", range(4))
def test_pieces_go_to_the_cheapest_sequence_with_room(seed):
    rng = np.random.default_rng(seed)
    sizes = np.minimum(rng.lognormal(5.5, 1.1, 900).astype(int) + 1, 2047).tolist()
    got = {(d, start): (n, sequence) for d, start, n, sequence, _ in packing.pack(sizes)}
    assert got == cheapest_with_room(sizes, 2048)


def test_costs_are_even():
    rng = np.random.default_rng(5)
    pieces = packing.pack(rng.integers(20, 400, 600).tolist())
    cost = Counter()
    for _, _, length, sequence, _ in pieces:
        cost[sequence] += packing.cost(length)
    full = sorted(cost.values())[1:]
    assert max(full) / min(full) < 1.4


def test_ids_are_those_of_the_vocabulary(documents, monkeypatch):
    monkeypatch.setattr(packing, "POOL_TOKENS", 5000)
    rng = np.random.default_rng(3)
    letters = [chr(c) for c in range(0x20, 0x250)] + list("漢字текст😀 \xa0\n\t ''")
    rows = [(i, "".join(rng.choice(letters, int(rng.integers(0, 400)))), "en", "s") for i in range(80)]
    rows += [(200, "it's we'll don't  <|endoftext|>  \n\n x", "en", "s"), (201, "a <|endoftext|> b", "en", "s"), *[r for r in ODD if r[0] != 9010]]
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in queries.packed(documents(rows)).collect():
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == {r[0] for r in rows}
    for doc_id, text, *_ in rows:
        ids = np.array([*own.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        at = 0
        for p in sorted(pieces[doc_id], key=lambda p: p["start"]):
            assert (p["start"], p["doc_tokens"]) == (at, len(ids))
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    for parts in sequences.values():
        ends = [o + n for o, n in sorted(parts)]
        assert [o for o, _ in sorted(parts)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert queries.packed(documents([])).count() == 0


def test_ids_of_very_long_white_space(documents):
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = 2_000_000
    texts = ["a" + " " * n + "x", "a\n" + "\n" * n + "x", " " * n, "it's" + " " * n + "\n!" + "\n" * n + "b \x1c c"]
    found = queries.packed(documents([(i, t, "en", "s") for i, t in enumerate(texts)])).collect()
    for i, text in enumerate(texts):
        ids = np.array([*own.encode(text, add_special_tokens=False).ids, 1], dtype="<u4")
        pieces = sorted((p for p in found if p["doc_id"] == i), key=lambda p: p["start"])
        assert sum(p["length"] for p in pieces) == len(ids) == pieces[0]["doc_tokens"]
        assert all(p["ids_crc32"] == zlib.crc32(ids[p["start"] : p["start"] + p["length"]].tobytes()) for p in pieces)


def test_ids_where_runs_of_white_space_are_cut(monkeypatch):
    monkeypatch.setattr(packing, "SAFE_RUN", 3)
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing._encoder(public_tokenizers.path(queries.VOCABULARY), public_tokenizers.PATTERN, queries.SPECIAL)
    rng = np.random.default_rng(8)
    letters = [*"   \n\n\t\x85\xa0\u2009\u3000\x1c\x1fa's1!é字", "<|endoftext|>", "<|endof"]
    for _ in range(3000):
        text = "".join(rng.choice(letters, int(rng.integers(0, 40))))
        assert encode(text) == own.encode(text, add_special_tokens=False).ids, repr(text)


def test_hilbert_curve_visits_each_cell_by_single_steps(spark):
    cells = spark.range(1 << 12).select(
        *[F.pmod(F.shiftright("id", 4 * i), F.lit(16)).cast("int").alias(n) for i, n in enumerate("xyz")]
    )
    rows = cells.withColumn("h", sharding.hilbert_index([F.col(n) for n in "xyz"], 4)).orderBy("h").collect()
    assert [r["h"] for r in rows] == list(range(1 << 12))
    path = np.array([tuple(r)[:3] for r in rows])
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_sharding(documents):
    rng = np.random.default_rng(2)
    rows = [(i, prose(rng, int(rng.integers(1, 90))), ["en", "de", None][i % 3], f"site{i % 40}") for i in range(500)]
    rows += [(1000 + i, "equal text of many", "en", "site1") for i in range(250)] + ODD
    got = sharding.shard_documents(documents(rows)).collect()
    assert len(got) == len(rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r["shard"]].append(r)
    counts = [len(by_shard[s]) for s in range(16)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    top = -1
    for s in range(16):
        assert sorted(r["slot"] for r in by_shard[s]) == list(range(len(by_shard[s])))
        ordered = [r["curve"] for r in sorted(by_shard[s], key=lambda r: r["slot"])]
        assert ordered == sorted(ordered) and ordered[0] >= top
        top = ordered[-1]
    text_of = {r[0]: r[1] for r in rows}
    for r in got:
        if r["doc_id"] is not None:
            data = (text_of[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 1, zlib.crc32(data))
            assert r["law"] == "rows" and r["grown_shard"] is None
    assert sharding.shard_documents(documents([])).count() == 0


def test_sharding_prunes(documents):
    """A shard holds a narrow range of at least one of the dimensions."""
    rng = np.random.default_rng(4)
    rows = [(i, prose(rng, int(rng.integers(1, 90))), "en", f"site{i % 40:02}") for i in range(1600)]
    got = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(documents(rows)).collect()}
    touched = [len({got[r[0]] for r in rows if r[3] == f"site{s:02}"}) for s in range(40)]
    assert np.mean(touched) < 9  # of 16


def test_one_odd_source_does_not_undo_a_dimension(documents):
    rng = np.random.default_rng(9)
    rows = [(i, prose(rng, int(rng.integers(1, 90))), ["en", "de"][i % 2], f"https://site{i % 20:02}.example") for i in range(4000)]
    touched = []
    for more in ([], [(5000, "one more", "en", "arxiv")]):
        got = {r["doc_id"]: r["shard"] for r in sharding.shard_documents(documents(rows + more)).collect()}
        touched.append(np.mean([len({got[r[0]] for r in rows if r[3] == rows[s][3]}) for s in range(20)]))
    assert touched[1] < 7 and abs(touched[1] - touched[0]) < 1.5


def test_sharding_by_hand(documents):
    """Every row's place from steps and order worked out row by row; the curve itself is tested above."""
    rng = np.random.default_rng(12)
    rows = [(i, prose(rng, int(rng.integers(0, 30))), [None, "de", "en"][int(rng.integers(3))], f"s{int(rng.integers(50)) ** 2 // 50}") for i in range(700)]
    rows += [(2000 + i, "same text", "en", None) for i in range(60)]
    got = {r["doc_id"]: r for r in sharding.shard_documents(documents(rows)).collect()}
    size = lambda r: len((r[1] or "").encode()) + 1
    keys = [lambda r: (r[3] is not None, r[3] or ""), lambda r: (r[2] is not None, r[2] or ""), size]

    def cell(r):
        return tuple(sum(k(o) < k(r) for o in rows) * 32 // len(rows) for k in keys)

    # Cells and numbers of the curve belong together one to one.
    cells, numbers = {r[0]: cell(r) for r in rows}, {i: r["curve"] for i, r in got.items()}
    assert len({(cells[i], numbers[i]) for i in cells}) == len(set(cells.values())) == len(set(numbers.values()))
    order = sorted(rows, key=lambda r: (numbers[r[0]], zlib.crc32((r[1] or "").encode()), size(r), keys[0](r), keys[1](r), r[0]))
    for place, r in enumerate(order):
        shard = place * 16 // len(rows)
        first = -(-shard * len(rows) // 16)
        assert (got[r[0]]["shard"], got[r[0]]["slot"]) == (shard, place - first)


def test_pipeline(spark, documents, labels, tmp_path):
    rng = np.random.default_rng(10)
    rows, marks = [], []
    for i in range(300):
        good = i % 6 != 0
        text = "\n".join(prose(rng, int(rng.integers(8, 18))) for _ in range(1 if i % 5 == 2 else rng.integers(4, 16)))
        if i % 5 == 2:
            text = prose(rng, int(rng.integers(60, 200)))
        rows.append((i, text if good else text.upper().replace(" ", "!! "), "en", f"src{i % 3}"))
        marks.append((i, int(good), 0))
    copies = [(1000 + i, prose(np.random.default_rng(77), 120), "en", "src1") for i in range(9)]
    passage = "\n".join(prose(rng, 12) for _ in range(4))
    shared = [(2000 + i, passage + "\n" + "\n".join(prose(rng, 14) for _ in range(5)), "en", "src2") for i in range(5)]
    docs = documents(rows + copies + shared + ODD)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels(marks).write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = seen[name] = spark.read.parquet(f"{tmp_path}/{name}")
    ids = {n: [r[0] for r in d.select("doc_id").collect()] for n, d in seen.items()}
    assert not set(range(0, 300, 6)) & set(ids["quality"])
    assert len({i for i in range(300) if i % 6} - set(ids["quality"])) <= 5
    texts = {r["doc_id"]: r["text"] for r in seen["line_dedup"].collect()}
    assert passage in texts[2000] and all(passage not in texts[2000 + i] for i in range(1, 5))
    assert [i for i in ids["near_duplicates"] if i and 1000 <= i < 1009] == [1000]
    assert len([i for i in ids["near_duplicates"] if i == 9010]) <= 1
    sizes = {r["doc_id"]: len(words(r["text"])) for r in seen["near_duplicates"].collect()}
    total = sum(sizes[i] for i in ids["mixing"])
    assert abs(total - sum(sizes.values())) < 0.2 * sum(sizes.values())
    assert set(ids["packing"]) == set(ids["mixing"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.count() == seen["packing"].count()
    assert corpus_pipeline.ORACLE_SQL is None


def test_pipeline_of_nothing(spark, documents, labels, tmp_path):
    documents([]).write.parquet(f"{tmp_path}/documents.parquet")
    labels([]).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_without_labels(spark, documents, labels, tmp_path):
    documents(ODD).write.parquet(f"{tmp_path}/documents.parquet")
    labels([]).write.parquet(f"{tmp_path}/labels.parquet")
    for row in corpus_pipeline.run(spark, str(tmp_path)).select("length", "doc_tokens").collect():
        assert 0 < row["length"] <= row["doc_tokens"]


def test_registered():
    names = [n.split("_")[0] for n in queries.queries()]
    assert names == [f"op{i}" for i in range(1, 14)]
    assert set(queries.oracle_sql()) <= set(queries.queries())
