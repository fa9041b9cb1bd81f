"""Learned operators: parts against brute force, the whole by held-out accuracy."""

from __future__ import annotations

import zlib
from fractions import Fraction
from math import comb, log

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from coffer.llm import language, quality, rules, toxicity

from .conftest import ODD, prose


def held_out(doc_id, modulus, rest):
    return zlib.crc32(str(doc_id).encode()) % modulus == rest


LANGS = {
    "en": "the of and that is was with thing ation ing ould there which house".split(),
    "de": "der die und das ist nicht schaft ung heit keit werden straße über".split(),
    "fr": "le la les des est une dans être après où français eau chez qui".split(),
}


@pytest.fixture(scope="module")
def texts(documents):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        lang = list(LANGS)[i % 3]
        rows.append((i, prose(rng, int(rng.integers(8, 120)), LANGS[lang]), lang if i % 11 else None, f"src{i % 4}"))
    return rows


def test_kernel_is_the_share_of_common_grams():
    texts = ["abcab", "abx", ""]
    t = next(iter(language._texts(pa.array(texts, pa.large_string()))))
    held = np.concatenate([h for _, h in language._presence(t)])
    grams = [{s[i : i + n] for n in language.ORDERS for i in range(len(s) - n + 1)} for s in texts]
    assert held.sum(axis=1).tolist() == [len(g) for g in grams]
    assert (held[0] & held[1]).sum() == len(grams[0] & grams[1])


def test_language(documents, texts):
    rows = texts + ODD
    got = {r["doc_id"]: r for r in language.identify(documents(rows)).collect()}
    truth = {i: list(LANGS)[i % 3] for i in range(400)}
    assert np.mean([got[i]["lang_pred"] == truth[i] for i in truth if held_out(i, 5, 0)]) > 0.97
    assert all(got[i]["held_out"] == held_out(i, 5, 0) for i in truth)
    for i in (9001, 9002, 9003, 9004, 9011):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_language_without_anything_to_learn(documents):
    assert language.identify(documents([])).count() == 0
    got = language.identify(documents([(1, "some text", None, None), (2, None, "en", None)])).collect()
    assert {r["lang_pred"] for r in got} == {"und"}


def test_isotonic_is_the_closest_rising_sequence():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n = int(rng.integers(1, 9))
        weights = rng.integers(1, 6, n).astype(float)
        ones = np.array([rng.integers(0, w + 1) for w in weights], dtype=float)
        got = quality.isotonic(np.arange(n, dtype=float), ones, weights)
        # Min-max formula of isotonic regression.
        want = [
            max(
                min(ones[a : b + 1].sum() / weights[a : b + 1].sum() for b in range(i, n))
                for a in range(i + 1)
            )
            for i in range(n)
        ]
        assert np.allclose(got, want)


def junk(rng, i):
    text = prose(rng, 120)
    return [text.upper().replace(" ", "!! "), " ".join(["spam"] * 150), text.replace(" ", "### ")][i % 3]


@pytest.fixture(scope="module")
def graded(documents, labels):
    rng = np.random.default_rng(6)
    rows, marks = [], []
    for i in range(600):
        good = i % 4 != 0
        rows.append((i, prose(rng, int(rng.integers(60, 250))) if good else junk(rng, i), "en", "src0"))
        marks.append((i, int(good), 0))
    return documents(rows + ODD), labels(marks + [(None, 1, 1), (9001, 1, 0), (0, 0, 0), (77777, 1, 1), (3, None, None)])


def test_quality(graded):
    got = {r["doc_id"]: r for r in quality.score_documents(*graded).collect()}
    out = [i for i in range(600) if held_out(i, 3, 1)]
    assert np.mean([got[i]["predicted"] == (i % 4 != 0) for i in out]) > 0.97
    assert all(got[i]["held_out"] == held_out(i, 3, 1) for i in range(600))
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got.values())


def test_quality_without_labels(documents, labels):
    got = quality.score_documents(documents(ODD), labels([])).collect()
    assert len(got) == len(ODD) and {r["score"] for r in got} == {0.5}
    assert quality.score_documents(documents([]), labels([])).count() == 0


@pytest.mark.parametrize("rows", [100, 250, 6000])  # both classes thinned, one, none
def test_quality_rates_do_not_depend_on_the_sample(documents, labels, monkeypatch, rows):
    """Texts that cannot be told apart, three quarters of them good, score three quarters."""
    monkeypatch.setattr(quality, "CALIBRATION_ROWS", rows)
    docs = documents([(i, "one text for all of them", "en", "s") for i in range(1600)])
    marks = labels([(i, int(i % 4 != 0), 0) for i in range(1600)])
    got = quality.score_documents(docs, marks).select("score", "predicted").distinct().collect()
    assert len(got) == 1
    assert got[0]["score"] == pytest.approx(0.75, abs=0.05) and got[0]["predicted"] == 1


def test_fourier_features_approximate_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.standard_normal((40, 15))
    directions = np.random.default_rng(quality.SEED).standard_normal((15, 20000)) / quality.WIDTH
    phases = np.random.default_rng(3).uniform(0, 2 * np.pi, 20000)
    waves = np.cos(x @ directions + phases) * np.sqrt(2 / 20000)
    gauss = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * quality.WIDTH**2))
    assert np.abs(waves @ waves.T - gauss).max() < 0.06


def test_binomial_tail_is_exact():
    for n, wrong, rate in ((50, 0, 0.1), (120, 3, 0.05), (200, 9, 0.05), (400, 1, 0.005)):
        p = Fraction(rate)
        exact = sum(comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(wrong + 1))
        assert abs(rules.log_tail(wrong, n, rate) - log(exact)) < 1e-9


def test_cutoffs_stop_at_the_first_bound_that_fails():
    levels = len(rules.LEVELS)
    cutoffs = np.arange(levels)[::-1].reshape(levels, 1, 1) * np.ones((1, 1, 2), dtype=np.int64)
    good, bad = np.zeros((1, levels + 1)), np.zeros((1, levels + 1))
    good[0, -1], good[0, 2], bad[0, :3] = 5000, 300, 100
    assert rules.choose(cutoffs, good, bad)[0].tolist() == cutoffs[1, 0].tolist()
    few = good * 0
    few[0, -1] = 100  # too few good texts to promise anything
    assert (rules.choose(cutoffs, few, bad) == rules.STEPS).all()


def test_false_rejections_stay_below_the_rate():
    """Repeated draws from one law: the true rate passes the limit in few of them."""
    rng = np.random.default_rng(11)
    broken, cells = 0, rules.STEPS + 1
    law = np.exp(-np.arange(cells) / 9.0)
    law /= law.sum()
    for _ in range(200):
        learn = rng.multinomial(3000, law).reshape(1, 1, cells)
        cutoffs = rules.offered(learn)
        hold = rng.choice(cells, 3000, p=law)
        first = rules._first_level(hold[:, None], np.zeros(3000, dtype=np.int64), cutoffs)
        good = np.bincount(first, minlength=len(rules.LEVELS) + 1)[None]
        bad = np.ones((1, len(rules.LEVELS) + 1)) * 100
        step = rules.choose(cutoffs, good, bad)[0, 0]
        broken += law[step + 1 :].sum() > rules.FALSE_REJECTION
    assert broken / 200 <= rules.RISK + 0.03


def test_rules(documents, labels):
    rng = np.random.default_rng(12)
    rows, marks = [], []
    for i in range(3200):
        good = i % 8 != 0
        rows.append((i, prose(rng, int(rng.integers(60, 190))) if good else prose(rng, 60).replace(" ", "&&& "), "en", "s"))
        marks.append((i, int(good), 0))
    got = {r["doc_id"]: r for r in rules.judge_documents(documents(rows + ODD), labels(marks)).collect()}
    assert not any(got[i]["kept"] for i in range(0, 3200, 8))
    assert np.mean([got[i]["kept"] for i in range(3200) if i % 8]) > 0.99
    assert got[9001]["base_failed"] and not got[9001]["kept"] and got[9001]["n_words"] == 0
    assert got[9006]["n_repeat_words"] == 200_000 and got[9006]["base_failed"]


def test_equal_texts_are_one_draw(documents, labels):
    """Copies of a few texts are too few draws to prove a cutoff, however many rows they fill."""
    rng = np.random.default_rng(3)
    few = [prose(rng, 80) for _ in range(40)]
    rows = [(i, few[i % 40], "en", "s") for i in range(2000)]
    rows += [(5000 + i, prose(rng, 60).replace(" ", "&&& "), "en", "s") for i in range(400)]
    marks = [(r[0], int(r[0] < 5000), 0) for r in rows]
    assert (rules.fit(documents(rows), labels(marks)).steps == rules.STEPS).all()
    rows[:2000] = [(i, prose(rng, 80), "en", "s") for i in range(2000)]
    assert (rules.fit(documents(rows), labels(marks)).steps < rules.STEPS).any()


def test_base_counts_equal_sql(documents, labels, tmp_path):
    """The counts of the base rules, as DuckDB has them."""
    rng = np.random.default_rng(4)
    letters = [*"ab  \t\n\n#*$é", "the cat sat ", "same line\n"]
    rows = [(i, "".join(rng.choice(letters, int(rng.integers(0, 120)))), "en", "s") for i in range(200)]
    # SQL copies a text's words once per word.
    rows += [r for r in ODD if r[0] != 9006]
    docs = documents(rows)
    docs.write.parquet(f"{tmp_path}/documents")
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = rules.judge_documents(docs, labels([])).select(*names).collect()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, con.execute(BASE_SQL).fetchall()))


BASE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS place, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (
  SELECT place, line, count(*) AS n FROM (SELECT place, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL),
grams AS (SELECT place, i, w[i:i + 2] AS g FROM (SELECT place, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT place, i FROM grams JOIN (SELECT place, g FROM grams GROUP BY ALL HAVING count(*) > 1) USING (place, g)),
hit AS (SELECT place, count(DISTINCT i + k) AS n FROM twice, (VALUES (0), (1), (2)) t(k) GROUP BY place)
SELECT doc_id, len(w), coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT,
       length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')),
       coalesce((SELECT sum(n - 1) FROM lines l WHERE l.place = d.place), 0)::BIGINT,
       coalesce(h.n, 0), len(w) < 50 OR 100 * coalesce(h.n, 0) > 50 * len(w)
FROM d LEFT JOIN hit h USING (place)
"""


def test_rules_without_labels_reject_by_the_base_alone(documents, labels):
    rng = np.random.default_rng(1)
    got = rules.judge_documents(documents([(1, prose(rng, 80), "en", "s"), *ODD]), labels([])).collect()
    assert {r["doc_id"] for r in got if r["kept"]} == {1}
    assert rules.judge_documents(documents([]), labels([])).count() == 0


def test_label_model_finds_accuracies_and_copies():
    rng = np.random.default_rng(7)
    n = 20_000
    y = rng.random(n) < 0.5
    truth = np.where(y, 1, -1)
    rates = [0.9, 0.75, 0.6, 0.8]
    cast = [np.where(rng.random(n) < r, truth, -truth) for r in rates]
    cast += [cast[2], cast[2], cast[2]]  # one weak voter, four times
    patterns, counts = np.unique(np.stack(cast, axis=1), axis=0, return_counts=True)
    model = toxicity.fit_label_model(patterns, counts.astype(float), 0.5)
    assert model.chances[0, 1, 2] == pytest.approx(0.9, abs=0.06)
    assert model.trust[2] < 0.4 < model.trust[0]
    p = toxicity.posterior(model, np.stack(cast, axis=1))
    assert ((p > 0.5) == y).mean() > 0.88


def test_toxicity(documents, labels):
    rng = np.random.default_rng(9)
    rows, marks = [], []
    for i in range(900):
        text, toxic = prose(rng, int(rng.integers(20, 200))).split(" "), i % 5 == 0
        if toxic:
            stem = "zarlo" if i % 2 else "idiot"
            for at in rng.integers(0, len(text), 4):
                text[at] = stem if stem == "idiot" else stem + str(text[at])[:3].replace("w", "qu")
        rows.append((i, " ".join(text), "en", "s"))
        marks.append((i, 1, int(toxic)))
    got = {r["doc_id"]: r for r in toxicity.score_documents(documents(rows + ODD), labels(marks)).collect()}
    out = [i for i in range(900) if held_out(i, 5, 0)]
    assert np.mean([got[i]["predicted"] == (i % 5 == 0) for i in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert all(got[i]["predicted"] == 0 for i in (9001, 9002, 9003, 9004, 9007))


def test_words_beside_marks_are_hits():
    terms = toxicity.Terms(["idiot"], ["moro"])
    texts = ["“idiot”", "idiot…", "you—idiot", "an\u00a0idiot", "‘Moronic’ —idiot!", "idiotа", "", None]
    counts, sizes = toxicity.term_counts(pa.array(texts), terms)
    assert counts[:, 0].tolist() == [1, 1, 1, 1, 1, 0, 0, 0] and counts[:, 1].tolist() == [0, 0, 0, 0, 1, 0, 0, 0]
    assert sizes.tolist() == [1, 1, 2, 2, 2, 1, 0, 0]


def test_learned_terms_are_found_again(spark):
    """Scripts with combining marks, marks of punctuation, and letters with two lower cases."""
    bad = ["मूर्ख", "โง่เง่า", "ΚΑΚΟΣ", "İzbıq", "naïf"]
    rows = [(f"“{w}”…{w}—mid", 1) for w in bad for _ in range(6)] + [("a fine day mid", 0)] * 300
    terms = toxicity.learn_terms(spark.createDataFrame(rows, "text string, y int"))
    assert len(terms.words) == len(toxicity.INSULTS) + len(bad)
    counts, sizes = toxicity.term_counts(pa.array([f"–{w}’" for w in bad]), terms)
    assert sizes.tolist() == [1] * len(bad)
    assert counts[:, len(toxicity.INSULTS) : len(terms.words)].sum(axis=1).tolist() == [1] * len(bad)


def test_toxicity_without_labels(documents, labels):
    rows = [(1, "you are an idiot and a moron", "en", "s"), (2, "a fine day it is", "en", "s"), *ODD]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.score_documents(documents(rows), labels([])).collect()}
    assert got[1] == 1 and got[2] == 0
    assert toxicity.score_documents(documents([]), labels([])).count() == 0
