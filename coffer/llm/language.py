"""Language of a text by a string kernel.

The blended-spectrum presence kernel of two texts is the number of byte n-grams (orders
2 to 5, ASCII letters in lower case) that both hold, over the root of the product of
their own numbers.  Landmark texts of each language span a Nyström approximation of the
kernel's space, and one-versus-rest ridge regression learns there.  A text is scored by
three matrix products: presence by landmark, whitening, weights.

N-grams are hashed to 2**16 cells, so presence is a bit vector of fixed width.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import bounded_batches, remainder, share
from coffer.llm.words import Texts, mix, slices

ORDERS = (2, 3, 4, 5)
CELLS = 1 << 16

# Bounds of what the fit takes; everything else covers all rows.
LANDMARKS_PER_LANG = 24
ROWS_PER_LANG = 1500
MAX_LANGS = 200
RIDGE = 1e-2

# Texts whose presence rows are held at once.
BLOCK = 128

HAS_LETTER = r"\p{L}"


@dataclass
class LanguageModel:
    langs: list[str]
    cells: np.ndarray  # cells that some landmark holds
    landmarks: np.ndarray  # presence of those cells, by landmark, over the root of its size
    whiten: np.ndarray
    weights: np.ndarray


def _presence(t: Texts) -> Iterator[tuple[slice, np.ndarray]]:
    """Presence rows of the texts, some at a time."""
    for begin in range(0, len(t), BLOCK):
        end = min(begin + BLOCK, len(t))
        low, high = t.offsets[begin], t.offsets[end]
        part = Texts(t.data[low:high], t.offsets[begin : end + 1] - low)
        held = np.zeros((end - begin, CELLS), dtype=bool)
        owner = np.repeat(np.arange(end - begin), np.diff(part.offsets))
        if len(part.data):
            code = np.zeros(len(part.data), dtype=np.uint64)
            for order in range(1, max(ORDERS) + 1):
                n = len(part.data) - order + 1
                if n <= 0:
                    break
                code = (code[:n] << np.uint64(8)) | part.data[order - 1 :].astype(np.uint64)
                if order in ORDERS:
                    at = np.flatnonzero(owner[:n] == owner[order - 1 :])
                    cell = mix(code[at] + np.uint64(order << 56)) >> np.uint64(48)
                    held[owner[at], cell.astype(np.int64)] = True
        yield slice(begin, end), held


def _kernel(model: LanguageModel, held: np.ndarray) -> np.ndarray:
    """Kernel of presence rows with the landmarks."""
    size = np.maximum(held.sum(axis=1), 1).astype(np.float32)
    shared = held[:, model.cells].astype(np.float32) @ model.landmarks.T
    return (shared / np.sqrt(size)[:, None]).astype(np.float64)


def _texts(array: pa.Array) -> Iterator[Texts]:
    for t in slices(array):
        yield t.lower()


def _sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, rule: Column) -> DataFrame:
    """About ``ROWS_PER_LANG`` learnable texts of each language, chosen by a hash of the id.

    Texts are cleared of nothing and cut nowhere; repeated ids stay in proportion.
    """
    known = docs.filter(
        rule & F.col(lang_col).isNotNull() & F.col(text_col).rlike(HAS_LETTER) & F.col(id_col).isNotNull()
    ).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    wanted = F.lit(False)
    for lang, n in counts:
        wanted |= (F.col("lang") == lang) & (share("lang", "id") < F.lit(min(1.0, ROWS_PER_LANG / n)))
    return known.filter(wanted).select("text", "lang", share("landmark", "id", "text").alias("rank"))


def fit(
    docs: DataFrame,
    rule: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> LanguageModel:
    """Learn from rows that satisfy ``rule`` and have a language, an id and a letter.

    The fit sees about 1,500 texts of each of the 200 most frequent languages at most.
    No such row at all gives a model that answers ``und``.
    """
    bounded_batches(docs.sparkSession)
    rule = F.lit(True) if rule is None else rule
    sample = _sample(docs, id_col, text_col, lang_col, rule).repartition(16, "rank").cache()
    try:
        langs = [r[0] for r in sample.select("lang").distinct().orderBy("lang").collect()]
        if not langs:
            return LanguageModel([], *[np.zeros((0, 0))] * 4)
        marks = []
        for lang in langs:
            rows = sample.filter(F.col("lang") == lang).orderBy("rank", "text").limit(LANDMARKS_PER_LANG)
            marks += [r[0] for r in rows.select("text").collect()]
        model = _landmark_model(langs, marks)
        return _ridge(sample, model)
    finally:
        sample.unpersist()


def _landmark_model(langs: list[str], marks: list[str]) -> LanguageModel:
    held = np.concatenate([h for t in _texts(pa.array(marks, pa.large_string())) for _, h in _presence(t)])
    cells = np.flatnonzero(held.any(axis=0))
    size = np.maximum(held.sum(axis=1), 1)
    rows = (held[:, cells] / np.sqrt(size)[:, None]).astype(np.float32)
    # Directions of next to no weight are left out: equal landmarks give some.
    values, vectors = np.linalg.eigh((rows @ rows.T).astype(np.float64))
    strong = values > 1e-6 * values.max()
    whiten = vectors[:, strong] / np.sqrt(values[strong])
    return LanguageModel(langs, cells, rows, whiten, np.zeros((whiten.shape[1] + 1, len(langs))))


def _features(model: LanguageModel, held: np.ndarray) -> np.ndarray:
    x = _kernel(model, held) @ model.whiten
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def _ridge(sample: DataFrame, model: LanguageModel) -> LanguageModel:
    """Normal equations summed per partition; each language weighs the same."""
    langs = {lang: i for i, lang in enumerate(model.langs)}

    def sums(batches):
        width = model.weights.shape[0]
        left, right = np.zeros((len(langs), width, width)), np.zeros((len(langs), width))
        seen = np.zeros(len(langs))
        for batch in batches:
            y = np.array([langs[v] for v in batch.column("lang").to_pylist()], dtype=np.int64)
            at = 0
            for t in _texts(batch.column("text")):
                for rows, held in _presence(t):
                    x, own = _features(model, held), y[at + rows.start : at + rows.stop]
                    for i in np.unique(own):
                        xi = x[own == i]
                        left[i] += xi.T @ xi
                        right[i] += xi.sum(axis=0)
                        seen[i] += len(xi)
                at += len(t)
        columns = [pa.array([a.tobytes()], pa.binary()) for a in (left, right, seen)]
        yield pa.RecordBatch.from_arrays(columns, ["left", "right", "seen"])

    width, k = model.weights.shape[0], len(langs)
    left, right, seen = np.zeros((k, width, width)), np.zeros((k, width)), np.zeros(k)
    for a, b, c in sample.select("text", "lang").mapInArrow(sums, "left binary, right binary, seen binary").collect():
        left += np.frombuffer(a).reshape(left.shape)
        right += np.frombuffer(b).reshape(right.shape)
        seen += np.frombuffer(c)
    weight = 1.0 / np.maximum(seen, 1)
    gram = (left * weight[:, None, None]).sum(axis=0)
    # Targets are 1 for the own language and 0 for the rest.
    target = (right * weight[:, None]).T
    model.weights = np.linalg.solve(gram + RIDGE * k * np.eye(width) / width, target)
    return model


def predict(text: Column, model: LanguageModel) -> Column:
    """Struct of ``lang_pred`` and ``score`` (0 to 1).

    NULL, empty texts and texts without a letter give ``und`` and 0.
    """
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    if not model.langs:
        return none

    def scored(texts: pa.Array) -> pa.Array:
        best, score = [], []
        for t in _texts(texts):
            for _, held in _presence(t):
                raw = _features(model, held) @ model.weights
                best.append(raw.argmax(axis=1))
                score.append(np.clip(raw.max(axis=1), 0.0, 1.0))
        names = np.array(model.langs, dtype=object)
        best = np.concatenate(best) if best else np.zeros(0, np.int64)
        score = np.concatenate(score) if score else np.zeros(0)
        return pa.StructArray.from_arrays([pa.array(names[best], pa.string()), pa.array(score)], ["lang_pred", "score"])

    found = F.arrow_udf(scored, "struct<lang_pred: string, score: double>")(text)
    return F.when(F.coalesce(text.rlike(HAS_LETTER), F.lit(False)), found).otherwise(none)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Predicted language of every row, learned from four fifths of the ids.

    Rows whose crc32 of the id, modulo 5, is 0 are held out.  One row out per row in,
    repeated and NULL ids included (a NULL id is never learned from).
    """
    model = fit(docs, remainder(id_col, 5) != 0, id_col, text_col, lang_col)
    found = docs.select(
        id_col, (remainder(id_col, 5) == 0).alias("held_out"), predict(F.col(text_col), model).alias("found")
    )
    return found.select(id_col, "held_out", "found.lang_pred", "found.score")
