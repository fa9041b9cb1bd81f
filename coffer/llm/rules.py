"""Quality rules whose thresholds hold a promise.

Each rule compares one number of a text with a cutoff.  One half of the good labelled
texts offers cutoffs, from lenient to strict: those that the highest shares of its numbers
pass.  The other half is the holdout: per stratum, cutoffs of all rules together are tested
in that order, and an exact binomial bound must show that good texts are rejected at no
more than a given rate.  Testing stops at the first bound that fails, so the sequence
needs no correction of its own; the strata share the risk of being wrong (Bonferroni).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import bounded_batches, checked_join
from coffer.llm.words import Texts, slices, text_stats
from coffer.session import materialise

# Words that every text needs, and the share of repeated words that none may pass.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50

# Rate of good texts rejected in a stratum, and the chance that any bound is wrong.
# A holdout of n good texts, none rejected, proves the rate from ln(share of the risk) / ln(1 - rate)
# on: 203 texts in each of three strata.
FALSE_REJECTION, RISK = 0.02, 0.05

# Strata are bands of the number of words; a text below the first fails anyway.
BANDS = (MIN_WORDS, 200, 600)

# Cutoffs that are offered, from lenient to strict: parts of the way from the largest number of
# a good text of the first half to the end of the range, then shares of these texts beyond.
MARGINS = (0.5, 0.25, 0.1, 0.05)
SHARES = (0.0, 1 / 8192, 1 / 4096, 1 / 2048, 1 / 1024, 1 / 512, 1 / 256)
LEVELS = MARGINS + SHARES

# Cutoffs are steps of each number's range (below).
STEPS = 100

# Rule: largest number it can tell apart.  All reject what lies above the cutoff.
RULES = {
    "symbols": 2.0,  # per word
    "duplicate_lines": 1.0,  # per line with a word
    "repeated_words": 0.5,  # per word
    "capitals": 1.0,  # per ASCII letter
    "marks": 2.0,  # exclamation and question marks per word
    "echoes": 1.0,  # words equal to the one before, per word
    "single_bytes": 1.0,  # words of one byte, per word
    "long_words": 20.0,  # characters per word
}

BASE = "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"


@dataclass
class Cutoffs:
    """Step above which a rule rejects, by stratum and rule; ``STEPS`` rejects nothing."""

    steps: np.ndarray


def _measures(stats: dict[str, np.ndarray]) -> np.ndarray:
    s = {k: v.astype(np.float64) for k, v in stats.items()}
    words, lines = np.maximum(s["n_words"], 1), np.maximum(s["n_lines"], 1)
    letters = np.maximum(s["n_upper"] + s["n_lower"], 1)
    rows = (
        s["n_symbols"] / words,
        s["n_dup_lines"] / lines,
        s["n_repeat_words"] / words,
        s["n_upper"] / letters,
        s["n_bangs"] / words,
        s["n_echo"] / words,
        s["n_short"] / words,
        s["word_chars"] / words,
    )
    return np.stack(rows, axis=1)


def _steps(stats: dict[str, np.ndarray]) -> np.ndarray:
    """The step 0 to ``STEPS`` of each rule's number; step ``i`` holds numbers up to ``i / STEPS`` of the range."""
    share = _measures(stats) / np.array(list(RULES.values()))
    return np.minimum(np.ceil(share * STEPS - 1e-9), STEPS).astype(np.int64)


def _strata(stats: dict[str, np.ndarray]) -> np.ndarray:
    return np.searchsorted(np.array(BANDS), stats["n_words"], side="right")


def _base_failed(stats: dict[str, np.ndarray]) -> np.ndarray:
    n = stats["n_words"]
    return (n < MIN_WORDS) | (100 * stats["n_repeat_words"] > MAX_REPEAT_PERCENT * n)


def log_tail(wrong: int, n: int, rate: float) -> float:
    """Log of the chance of at most ``wrong`` rejections among ``n`` at the given rate."""
    log = lambda k: (
        math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(rate) + (n - k) * math.log1p(-rate)
    )
    top = log(min(wrong, int(rate * n)))
    total = 0.0
    for k in range(min(wrong, n), -1, -1):
        term = math.exp(log(k) - top)
        total += term
        if k < rate * n and term < 1e-18 * total:
            break
    return min(0.0, top + math.log(total))


def offered(good: np.ndarray) -> np.ndarray:
    """Cutoff steps by level, stratum and rule, from counts of good texts by stratum, rule
    and step.  A stratum without good texts is offered nothing that rejects."""
    n = good.sum(axis=2, keepdims=True)
    above = n - np.cumsum(good, axis=2)
    top = (above <= 0).argmax(axis=2)
    steps = [top + np.ceil(margin * (STEPS - top)).astype(np.int64) for margin in MARGINS]
    steps += [(above <= share * n).argmax(axis=2) for share in SHARES]
    return np.stack([np.where(n[..., 0] > 0, s, STEPS) for s in steps])


def choose(
    cutoffs: np.ndarray, good: np.ndarray, bad: np.ndarray, rate: float = FALSE_REJECTION, risk: float = RISK
) -> np.ndarray:
    """One of the offered cutoffs per stratum.

    ``good`` and ``bad`` count holdout texts by stratum and by the first level that
    rejects them, with those that none rejects last.  The bound says: were the true rate
    of false rejection as high as ``rate``, so few rejections had a chance below the
    stratum's part of ``risk``, which strata without good holdout texts do not share.  Of the cutoffs before the first failure the one that best
    parts bad from good texts is taken, the more lenient of equals; without one, nothing is
    rejected by these rules.
    """
    levels, strata, rules = cutoffs.shape
    sharing = max(int((good.sum(axis=1) > 0).sum()), 1)
    out = np.full((strata, rules), STEPS, dtype=np.int64)
    for s in range(strata):
        n, n_bad = int(good[s].sum()), max(int(bad[s].sum()), 1)
        best = 0.0
        for level in range(levels):
            wrong = int(good[s, : level + 1].sum())
            if wrong >= rate * n or log_tail(wrong, n, rate) > math.log(risk / sharing):
                break
            gain = bad[s, : level + 1].sum() / n_bad - wrong / n
            if gain > best:
                best, out[s] = gain, cutoffs[level, s]
    return out


def _first_level(steps: np.ndarray, strata: np.ndarray, cutoffs: np.ndarray) -> np.ndarray:
    """First level at which some rule rejects each text, or the number of levels."""
    over = np.stack([(steps > c[strata]).any(axis=1) for c in cutoffs], axis=1)
    return np.where(over.any(axis=1), over.argmax(axis=1), len(cutoffs))


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality"
) -> Cutoffs:
    """Cutoffs from all labelled texts that pass the base rules.

    Halves are told apart by a hash of the text.  Texts are read once, to a table of steps,
    in which equal texts (by a 128-bit hash) become one; from it counts by stratum, rule and
    step are summed in Spark, whose number is fixed.
    """
    bounded_batches(docs.sparkSession)
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    known = materialise(known.groupBy(id_col).agg(F.max(label).cast("int").alias("y")), "labels")
    texts = docs.filter(F.col(text_col).isNotNull()).select(id_col, F.col(text_col).alias("text"))
    marks = [F.xxhash64(F.lit("holdout"), "text").alias("m1"), F.xxhash64("text").alias("m2")]
    texts = checked_join(texts, known, id_col, "inner").select("y", *marks, "text")

    def rows(batches):
        for batch in batches:
            done = 0
            for t in slices(batch.column("text")):
                stats = text_stats(t)
                fine = np.flatnonzero(~_base_failed(stats))
                steps = _steps(stats)[fine].astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(pa.array(fine + done)) for c in ("y", "m1", "m2")),
                        pa.array(_strata(stats)[fine].astype(np.int32)),
                        pa.array([r.tobytes() for r in steps], pa.binary()),
                    ],
                    ["y", "m1", "m2", "stratum", "steps"],
                )
                done += len(t)

    found = texts.mapInArrow(rows, "y int, m1 bigint, m2 bigint, stratum int, steps binary")
    # Equal texts have equal numbers; sums over them collapse before rows move.
    once = found.groupBy("m1", "m2", "stratum", "steps").agg(F.max("y").alias("y"))
    half = F.pmod(F.xxhash64(F.lit("half"), "m1", "m2"), F.lit(2)).cast("int").alias("half")
    found = materialise(once.select("y", half, "stratum", "steps"), "steps")
    strata, rules = len(BANDS) + 1, len(RULES)

    def steps_of(batch):
        flat = np.frombuffer(b"".join(batch.column("steps").to_pylist()), dtype=np.uint8)
        return flat.reshape(-1, rules).astype(np.int64), batch.column("stratum").to_numpy()

    def by_step(batches):
        total = np.zeros((strata, rules, STEPS + 1), dtype=np.int64)
        for batch in batches:
            steps, stratum = steps_of(batch)
            for r in range(rules):
                np.add.at(total, (stratum, r, steps[:, r]), 1)
        yield _cells(total)

    good = _counted(found.filter("half = 0 AND y = 1").select("stratum", "steps"), by_step, (strata, rules, STEPS + 1))
    cutoffs = offered(good)

    def by_level(batches):
        total = np.zeros((2, strata, len(LEVELS) + 1), dtype=np.int64)
        for batch in batches:
            steps, stratum = steps_of(batch)
            np.add.at(total, (batch.column("y").to_numpy(), stratum, _first_level(steps, stratum, cutoffs)), 1)
        yield _cells(total)

    held = found.filter("half = 1").select("y", "stratum", "steps")
    bad, good = _counted(held, by_level, (2, strata, len(LEVELS) + 1))
    return Cutoffs(choose(cutoffs, good, bad))


def _cells(total: np.ndarray) -> pa.RecordBatch:
    at = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel()[at])], ["cell", "n"])


def _counted(rows: DataFrame, count, shape: tuple[int, ...]) -> np.ndarray:
    table = np.zeros(math.prod(shape), dtype=np.int64)
    for cell, n in rows.mapInArrow(count, "cell bigint, n bigint").groupBy("cell").agg(F.sum("n")).collect():
        table[cell] = n
    return table.reshape(shape)


def verdict(text: Column, cutoffs: Cutoffs) -> Column:
    """Struct of the base counts, ``base_failed`` and ``kept``; NULL counts as empty."""

    def judged(texts: pa.Array) -> pa.Array:
        parts = [_judged(t, cutoffs) for t in slices(texts)]
        names = [*BASE, "base_failed", "kept"]
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)] * 2
        return pa.StructArray.from_arrays([pa.array(c) for c in columns], names)

    kinds = ", ".join(f"{n}: bigint" for n in BASE)
    return F.arrow_udf(judged, f"struct<{kinds}, base_failed: boolean, kept: boolean>")(text)


def _judged(t: Texts, cutoffs: Cutoffs) -> list[np.ndarray]:
    stats = text_stats(t)
    failed = _base_failed(stats)
    over = (_steps(stats) > cutoffs.steps[_strata(stats)]).any(axis=1)
    return [*(stats[n].astype(np.int64) for n in BASE), failed, ~failed & ~over]


def judge_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality"
) -> DataFrame:
    """Base counts and verdict of every row, repeated rows and NULL ids included.

    NULL, empty texts and texts of white space have no words and fail the base rules.
    """
    cutoffs = fit(docs, labels, id_col, text_col, label)
    return docs.select(id_col, verdict(F.col(text_col), cutoffs).alias("v")).select(id_col, "v.*")
