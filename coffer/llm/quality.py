"""Quality score of a text from counts of its words and lines.

Random Fourier features approximate a Gaussian kernel over standardised counts.  The
normal equations of a ridge fit are summed per partition; isotonic regression on other
labelled rows turns raw scores into rates of label 1.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import bounded_batches, labelled_sample, remainder
from coffer.llm.words import Texts, slices, text_stats

FEATURES = 256

# Tasks that add up what partitions have summed.
SUMS = 4
WIDTH = 4.0  # of the kernel, in standard deviations
LEAST_SCALE = 0.05  # of a statistic that hardly varies among labelled texts
RIDGE = 1e-3
SEED = 17

# Labelled texts per class that the two fits take at most, about.
FIT_ROWS = 6000
CALIBRATION_ROWS = 6000
BINS = 512


@dataclass
class QualityModel:
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores, rising
    rates: np.ndarray  # rate of label 1 at and above each edge


def statistics(t: Texts) -> np.ndarray:
    """One row of counts and shares per text; an empty text has zeros."""
    s = {k: v.astype(np.float64) for k, v in text_stats(t).items()}
    words, size = np.maximum(s["n_words"], 1), np.maximum(s["n_bytes"], 1)
    letters = np.maximum(s["n_upper"] + s["n_lower"], 1)
    lines = np.maximum(s["n_lines"], 1)
    columns = [
        np.log1p(s["n_words"]),
        s["word_chars"] / words,
        s["n_symbols"] / words,
        s["n_upper"] / letters,
        s["n_digits"] / size,
        s["n_bangs"] / words,
        s["n_stops"] / words,
        s["n_echo"] / words,
        s["n_short"] / words,
        s["n_top"] / words,
        s["n_distinct"] / words,
        s["n_distinct"] / np.sqrt(words),
        s["n_repeat_words"] / words,
        s["n_dup_lines"] / lines,
        np.log1p(words / lines),
    ]
    return np.stack(columns, axis=1)


def _all_statistics(texts: pa.Array) -> np.ndarray:
    parts = [statistics(t) for t in slices(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, 15))


def _fourier(model: QualityModel, x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model.centre) / model.scale, -6, 6)
    waves = np.cos(z @ model.directions + model.phases) * np.sqrt(2.0 / FEATURES)
    return np.concatenate([waves, np.ones((len(x), 1))], axis=1)


def _summed(sample: DataFrame, part, shapes: list[tuple[int, ...]]) -> list[np.ndarray]:
    """Arrays that ``part(texts, y, weight)`` gives for each batch, summed per partition, then in all.

    Sums of partitions are added up in ``SUMS`` tasks first: the driver gets that many, however
    many partitions there are.
    """
    names = [f"a{i}" for i in range(len(shapes))]

    def sums(batches):
        total = [np.zeros(s) for s in shapes]
        for batch in batches:
            y = np.asarray(batch.column("y").to_numpy(zero_copy_only=False), dtype=np.float64)
            weight = batch.column("weight").to_numpy(zero_copy_only=False)
            for a, b in zip(total, part(batch.column("text"), y, weight)):
                a += b
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in total], names)

    def added(batches):
        whole = [np.zeros(s) for s in shapes]
        for batch in batches:
            for column, a in zip(batch.columns, whole):
                for part in column:
                    a += np.frombuffer(part.as_py()).reshape(a.shape)
        yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in whole], names)

    schema = ", ".join(f"{n} binary" for n in names)
    total = [np.zeros(s) for s in shapes]
    for row in sample.mapInArrow(sums, schema).repartition(SUMS).mapInArrow(added, schema).collect():
        for a, b in zip(total, row):
            a += np.frombuffer(b).reshape(a.shape)
    return total


def isotonic(scores: np.ndarray, ones: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Rising rates closest to ``ones / weights`` in the order of ``scores`` (pooled neighbours)."""
    blocks: list[list[float]] = []
    for i in np.argsort(scores, kind="stable"):
        blocks.append([ones[i], weights[i], 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            o, w, n = blocks.pop()
            blocks[-1][0] += o
            blocks[-1][1] += w
            blocks[-1][2] += n
    return np.concatenate([np.full(int(n), o / w) for o, w, n in blocks])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rule: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "quality",
) -> QualityModel | None:
    """Learn from labelled rows that satisfy ``rule``; ``None`` when a class has no row.

    About 6,000 texts of each class fit the weights and as many others, told apart by a
    hash of the id, calibrate them.  Classes weigh the same in the fit; calibration
    undoes that: a row counts as many as its class has for each row drawn.
    """
    bounded_batches(docs.sparkSession)
    rule = F.lit(True) if rule is None else rule
    half = F.pmod(F.xxhash64(F.lit("half"), F.col(id_col)), F.lit(2)) == 0

    def sample(which: Column, rows: int) -> DataFrame:
        return labelled_sample(docs, labels, label, rows, "quality", id_col, text_col, rule & which)

    x_sample = sample(half, FIT_ROWS).repartition(8, "part").cache()
    y_sample = sample(~half, CALIBRATION_ROWS)
    try:
        return _fit(x_sample, y_sample)
    finally:
        x_sample.unpersist()


def _fit(sample: DataFrame, other: DataFrame) -> QualityModel | None:
    def moments(texts, y, weight):
        x = _all_statistics(texts)
        return np.array([(y == 0).sum(), (y == 1).sum()]), x.sum(axis=0), (x * x).sum(axis=0)

    seen, first, second = _summed(sample, moments, [(2,), (15,), (15,)])
    if not seen.all():
        return None
    centre = first / seen.sum()
    scale = np.maximum(np.sqrt(np.maximum(second / seen.sum() - centre**2, 0.0)), LEAST_SCALE)
    rng = np.random.default_rng(SEED)
    model = QualityModel(
        centre,
        scale,
        rng.standard_normal((15, FEATURES)) / WIDTH,
        rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + 1),
        np.zeros(0),
        np.zeros(0),
    )

    def normal(texts, y, weight):
        x = _fourier(model, _all_statistics(texts))
        w = np.where(y == 1, 1 / seen[1], 1 / seen[0])
        return x.T @ (x * w[:, None]), x.T @ (w * (2 * y - 1))

    width = FEATURES + 1
    gram, target = _summed(sample, normal, [(width, width), (width,)])
    model.weights = np.linalg.solve(gram + RIDGE * np.eye(width), target)

    # Classes were drawn at different rates; weights give back their true proportion.
    def binned(texts, y, weight):
        at = np.clip(((_raw(model, texts) + 2) / 4 * BINS).astype(np.int64), 0, BINS - 1)
        return np.bincount(at, weights=weight, minlength=BINS), np.bincount(at, weights=y * weight, minlength=BINS)

    count, ones = _summed(other, binned, [(BINS,), (BINS,)])
    if not count.any():  # every labelled id fell into the other half
        count, ones = _summed(sample, binned, [(BINS,), (BINS,)])
    at = np.flatnonzero(count)
    model.edges = at / BINS * 4 - 2
    model.rates = isotonic(at.astype(float), ones[at], count[at])
    return model


def _raw(model: QualityModel, texts: pa.Array) -> np.ndarray:
    return _fourier(model, _all_statistics(texts)) @ model.weights


def score(text: Column, model: QualityModel | None) -> Column:
    """Rate of label 1 among calibration texts that score alike, 0 to 1.

    A NULL text counts as empty.  Without a model every text scores 0.5.
    """
    if model is None:
        return F.lit(0.5)

    def scored(texts: pa.Array) -> pa.Array:
        raw = _raw(model, texts)
        at = np.clip(np.searchsorted(model.edges, raw, side="right") - 1, 0, len(model.rates) - 1)
        return pa.array(model.rates[at])

    return F.arrow_udf(scored, "double")(text)


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality"
) -> DataFrame:
    """Score of every row, learned from two thirds of the ids.

    Rows whose crc32 of the id, modulo 3, is 1 are held out.  One row out per row in,
    repeated and NULL ids included.
    """
    rest = remainder(id_col, 3)
    model = fit(docs, labels, rest != 1, id_col, text_col, label)
    scored = docs.select(id_col, (rest == 1).alias("held_out"), score(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_good(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality"
) -> DataFrame:
    """The rows that the classifier does not reject, with their columns."""
    model = fit(docs, labels, remainder(id_col, 3) != 1, id_col, text_col, label)
    return docs.filter(score(F.col(text_col), model) >= 0.5)
