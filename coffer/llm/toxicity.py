"""Toxicity by weak supervision.

Many weak voters look at a text: lexicons of single words and of word beginnings, counts
of hits, and patterns.  A generative label model, fitted to how the votes agree, estimates
how often each voter is right and which voters repeat each other, and gives each text a
probability.  A linear classifier learns from these probabilities and scores all texts.

Lexicons are a few fixed words and what labelled texts of the learnable part teach: words
and beginnings of words that toxic texts have and others do not.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import bounded_batches, labelled_sample, remainder
from coffer.llm.words import Texts, slices

# Common insults that any lexicon starts from.
INSULTS = (
    "idiot idiots moron morons stupid loser losers pathetic worthless scum trash garbage disgusting "
    "clown dumb imbecile cretin bastard bitch asshole shit fuck fucking jerk freak vermin"
).split()

# Beginnings of words, in characters, that the lexicons may hold.
PREFIXES = (4, 5, 6)

# Terms learned at most, and labelled texts per class that the fits take at most, about.
TERMS = 160
SAMPLE_ROWS = 4000

# A term must be in so many labelled toxic texts, and in so many times the share of others.
MIN_TEXTS, MIN_LIFT = 4, 12.0

# Lexicons that the terms are dealt to, by kind.
WORD_LEXICONS, PREFIX_LEXICONS = 6, 6
HIT_COUNTS = (1, 2, 4)

# Fits of the voters' strengths, and the correlation beyond them that makes a pair correlated.
STRENGTH_ROUNDS = 4
CORRELATED = 0.15

RIDGE = 1.0


@dataclass
class Terms:
    """Terms as hashes of their bytes: whole words, and beginnings by their number of bytes."""

    words: list[str]
    prefixes: list[str]

    @property
    def all(self) -> list[str]:
        return self.words + [p + "*" for p in self.prefixes]


@dataclass
class ToxicityModel:
    terms: Terms
    weights: np.ndarray
    slope: float
    shift: float


def _plain(texts: pa.Array) -> pa.Array:
    """Texts in lower case with a space for each run of what is neither letter nor combining mark."""
    return pc.replace_substring_regex(pc.utf8_lower(texts), r"[^\p{L}\p{M}]+", " ")


def _letters() -> np.ndarray:
    """Bytes of which words of plain texts are made: ASCII letters and all of other scripts."""
    table = np.zeros(256, dtype=bool)
    table[97:123] = table[65:91] = True
    table[128:] = True
    return table


def _hashes(terms: list[bytes]) -> np.ndarray:
    if not terms:
        return np.zeros(0, dtype=np.uint64)
    ends = np.cumsum([len(t) for t in terms])
    t = Texts(np.frombuffer(b"".join(terms), dtype=np.uint8), np.array([0, ends[-1]]))
    return t.hashes(ends - [len(t) for t in terms], ends)


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``keys`` that are in ``wanted``, and which one each is."""
    order = np.argsort(wanted)
    at = np.clip(np.searchsorted(wanted[order], keys), 0, len(wanted) - 1)
    hit = np.flatnonzero(wanted[order][at] == keys)
    return hit, order[at[hit]]


def term_counts(texts: pa.Array, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """How often each text has each term, and its number of words."""
    letters = _letters()
    whole = _hashes([w.encode() for w in terms.words])
    by_length: dict[int, list[int]] = {}
    for i, p in enumerate(terms.prefixes):
        by_length.setdefault(len(p.encode()), []).append(i)
    counts, sizes = [], []
    for t in slices(_plain(texts)):
        starts, ends = t.runs(letters[t.data])
        owner = t.text_of(starts)
        out = np.zeros((len(t), len(terms.words) + len(terms.prefixes)), dtype=np.int32)
        if len(whole) and len(starts):
            hit, which = _found(t.hashes(starts, ends), whole)
            np.add.at(out, (owner[hit], which), 1)
        for length, members in by_length.items():
            long = np.flatnonzero(ends - starts >= length)
            if len(long):
                wanted = _hashes([terms.prefixes[i].encode() for i in members])
                hit, which = _found(t.hashes(starts[long], starts[long] + length), wanted)
                np.add.at(out, (owner[long[hit]], len(terms.words) + np.array(members)[which]), 1)
        counts.append(out)
        sizes.append(np.bincount(owner, minlength=len(t)))
    if not counts:
        return np.zeros((0, len(terms.words) + len(terms.prefixes)), np.int32), np.zeros(0, np.int64)
    return np.concatenate(counts), np.concatenate(sizes)


def _at_least(k: int):
    return lambda word: F.length(word) >= k


def _beginning(k: int):
    return lambda word: F.concat(F.substring(word, 1, k), F.lit("*"))


def learn_terms(sample: DataFrame) -> Terms:
    """Terms that mark label 1 in the sample, on top of the fixed words.

    Each labelled text names each of its words and beginnings once; sums per term are made
    in Spark, and the strongest come back.
    """
    seen = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    if not seen.get(1) or not seen.get(0):
        return Terms(list(INSULTS), [])
    plain = F.arrow_udf(_plain, "string")("text")  # scoring cuts words by the same rule
    words = F.filter(F.split("plain", " "), lambda w: w != "")
    named = [words] + [
        F.transform(F.filter(words, _at_least(k)), _beginning(k)) for k in PREFIXES
    ]
    sample = sample.select("y", plain.alias("plain"))
    terms = sample.select("y", F.explode(F.array_distinct(F.flatten(F.array(*named)))).alias("term"))
    share_1 = (F.col("ones") + 0.1) / F.lit(float(seen[1]))
    share_0 = (F.col("zeros") + 0.5) / F.lit(float(seen[0]))
    strong = (
        terms.groupBy("term")
        .agg(F.sum("y").alias("ones"), F.sum(1 - F.col("y")).alias("zeros"))
        .filter((F.col("ones") >= MIN_TEXTS) & (share_1 / share_0 >= MIN_LIFT))
        .withColumn("weight", F.col("ones") * F.log(share_1 / share_0))
        .orderBy(F.desc("weight"), "term")
        .limit(TERMS)
        .collect()
    )
    learned = [r["term"] for r in strong]
    return Terms(
        list(dict.fromkeys(INSULTS + [t for t in learned if not t.endswith("*")])),
        [t[:-1] for t in learned if t.endswith("*")],
    )


def votes(counts: np.ndarray, sizes: np.ndarray, terms: Terms) -> np.ndarray:
    """Votes of all voters: 1 toxic, -1 not toxic, 0 no opinion.

    Lexicons vote toxic on a hit and else have no opinion, but for the last voters of a
    kind: the union of a kind votes against a text without any hit.  Pattern voters look
    at how many hits there are, how dense they are, and whether different terms occur.
    """
    n_words = len(terms.words)
    hits = counts > 0
    out = []
    for kind, lexicons in ((hits[:, :n_words], WORD_LEXICONS), (hits[:, n_words:], PREFIX_LEXICONS)):
        for i in range(lexicons):
            out.append(kind[:, i::lexicons].any(axis=1).astype(np.int8))
    total = counts.sum(axis=1)
    different = hits.sum(axis=1)
    for least in HIT_COUNTS:
        out.append(np.where(total >= least, 1, -1))
    out.append(np.where(different >= 2, 1, np.where(different == 0, -1, 0)))
    density = total / np.maximum(sizes, 1)
    out.append(np.where(density > 0.002, 1, np.where(total == 0, -1, 0)))
    return np.stack(out, axis=1).astype(np.int8)


@dataclass
class LabelModel:
    """Class balance, chance of each vote given the class, and weight of each voter."""

    prior: float
    chances: np.ndarray  # voter, class, vote + 1
    trust: np.ndarray


def _correlations(patterns: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Correlations of the voters over weighted rows; those of one that never changes are 0 but its own."""
    total = max(weight.sum(), 1e-9)
    centred = patterns - (weight @ patterns) / total
    covariance = (centred * weight[:, None]).T @ centred / total
    spread = np.sqrt(np.maximum(np.diag(covariance), 1e-9))
    out = covariance / np.outer(spread, spread)
    np.fill_diagonal(out, 1.0)
    return out


def fit_label_model(patterns: np.ndarray, counts: np.ndarray, prior: float) -> LabelModel:
    """Accuracies and correlations of voters from how they vote together; labels take no part.

    Voters that know nothing of each other but the class correlate by the product of their
    strengths, so strengths are the rank-one part of the correlations.  Pairs that go
    together beyond that are correlated themselves: they are left out of the next fit, and
    a voter's weight is one over one plus all it shares with others, so repeated opinions
    count once.
    """
    share = counts / counts.sum()
    together = _correlations(patterns, share)
    # Voters that vote alike share one voice in the fit and say nothing about each other.
    voice = 1.0 / (together**2).sum(axis=1)
    open_pairs = np.outer(voice, voice) * np.maximum(1 - together**2, 0.0)
    pairs = open_pairs
    strength = np.sqrt(voice)
    for _ in range(STRENGTH_ROUNDS):
        for _ in range(50):
            # Half a step each time: whole ones swing to and fro.
            fitted = (pairs * together) @ strength / np.maximum(pairs @ strength**2, 1e-9)
            strength = np.clip((strength + fitted) / 2, -0.99, 0.99)
        beyond = np.abs(together - np.outer(strength, strength))
        pairs = np.where(beyond > CORRELATED, 0.0, open_pairs)
    if strength @ voice < 0:  # voters are right more often than not
        strength = -strength
    np.fill_diagonal(beyond, 0.0)
    trust = 1.0 / (1.0 + np.where(beyond > CORRELATED, beyond, 0.0).sum(axis=1))

    # Each vote goes together with the other voters by their strengths, which gives the
    # difference its chance makes between the classes.
    one_hot = np.stack([(patterns == v) for v in (-1, 0, 1)], axis=2).astype(np.float64)
    rate = np.einsum("i,ijv->jv", share, one_hot)
    mean = share @ patterns
    spread = np.sqrt(np.maximum(share @ (patterns - mean) ** 2, 1e-9))
    standard = (patterns - mean) / spread
    cover = np.einsum("i,ijv,ik->jvk", share, one_hot - rate, standard)
    weight = np.maximum(pairs @ strength**2, 1e-9) * np.sqrt(prior * (1 - prior))
    change = np.einsum("jvk,jk,k->jv", cover, pairs, strength) / weight[:, None]
    chances = np.stack([rate - prior * change, rate + (1 - prior) * change], axis=1)
    chances = np.clip(chances, 1e-4, 1.0)
    return LabelModel(prior, chances / chances.sum(axis=2, keepdims=True), trust)


def _posterior(model: LabelModel, one_hot: np.ndarray) -> np.ndarray:
    odds = np.log(model.chances[:, 1] / model.chances[:, 0]) * model.trust[:, None]
    total = np.einsum("ijv,jv->i", one_hot, odds) + np.log(model.prior / (1 - model.prior))
    return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def posterior(model: LabelModel, patterns: np.ndarray) -> np.ndarray:
    """Probability of label 1 for rows of votes."""
    return _posterior(model, np.stack([(patterns == v) for v in (-1, 0, 1)], axis=2).astype(np.float64))


def _features(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Inputs of the linear classifier: presence of terms, and how many there are."""
    total = counts.sum(axis=1)
    more = [np.log1p(total), total > 0, total > 1, (counts > 0).sum(axis=1) > 1, np.minimum(total / np.maximum(sizes, 1) * 50, 2)]
    return np.column_stack([counts > 0, *more, np.ones(len(counts))]).astype(np.float64)


def _logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - target)) + ridge * w
        bend = (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    rule: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label: str = "toxic",
) -> ToxicityModel:
    """Learn from rows that satisfy ``rule``.

    About 4,000 labelled texts of each class give the terms and the sample on which voters
    vote; the label model sees votes only.  Labels come in three times: for the terms, for
    the balance of the classes, and at the end for two numbers that set the scale of the
    score.  Without labels of both classes the fixed words alone decide.
    """
    bounded_batches(docs.sparkSession)
    rule = F.lit(True) if rule is None else rule
    sample = labelled_sample(docs, labels, label, SAMPLE_ROWS, "toxic", id_col, text_col, rule).repartition(8, "part")
    sample = sample.cache()
    try:
        terms = learn_terms(sample)
        found = _patterns(sample, terms)
    finally:
        sample.unpersist()
    labelled = found[2]
    if len({*labelled}) < 2:
        labelled = labelled[:0]
        # A text for each term and as many without any.
        one = np.eye(len(terms.all), dtype=np.int32)
        counts = np.concatenate([np.zeros_like(one[:1]), one])
        y = (np.arange(len(counts)) > 0).astype(float)
        found = counts, np.full(len(counts), 10.0), y, np.where(y == 1, 1.0, len(one))
    counts, sizes, y, n = found
    patterns = votes(counts, sizes, terms)
    # Classes were drawn at different rates; the model sees them in equal shares.
    weight = n / np.where(y == 1, max(n[y == 1].sum(), 1), max(n[y == 0].sum(), 1))
    # Without labels the texts made above are their own answer.
    target = posterior(fit_label_model(patterns, weight, 0.5), patterns) if len(labelled) else y
    x = _features(counts, sizes)
    w = _logistic(x, target, weight * n.sum() / 2, RIDGE)
    raw = x @ w
    slope, shift = 1.0, 0.0
    if 0 < n[y == 1].sum() < n.sum():
        fitted = _logistic(np.column_stack([raw, np.ones(len(raw))]), y.astype(float), weight * n.sum() / 2, 1e-2)
        if fitted[0] > 0:
            slope, shift = fitted
    return ToxicityModel(terms, w, float(slope), float(shift))


def _patterns(sample: DataFrame, terms: Terms) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Counts of terms, sizes and labels in the sample, equal rows as one with their number."""

    def rows(batches):
        for batch in batches:
            counts, sizes = term_counts(batch.column("text"), terms)
            marks = [c.tobytes() for c in counts.astype("<u2")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.binary()), pa.array(sizes.astype(np.int64)), batch.column("y")], ["marks", "size", "y"]
            )

    grouped = (
        sample.mapInArrow(rows, "marks binary, size bigint, y int").groupBy("marks", "size", "y").count().collect()
    )
    if not grouped:
        return np.zeros((0, len(terms.all)), np.int32), np.zeros(0), np.zeros(0), np.zeros(0)
    counts = np.stack([np.frombuffer(r[0], "<u2") for r in grouped]).astype(np.int32)
    return (counts, *(np.array([r[i] for r in grouped], dtype=np.float64) for i in (1, 2, 3)))


def score(text: Column, model: ToxicityModel) -> Column:
    """Score from 0 to 1 of a text; NULL counts as empty."""

    def scored(texts: pa.Array) -> pa.Array:
        counts, sizes = term_counts(texts, model.terms)
        raw = _features(counts, sizes) @ model.weights * model.slope + model.shift
        return pa.array(1 / (1 + np.exp(-np.clip(raw, -40, 40))))

    return F.arrow_udf(scored, "double")(text)


def score_documents(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic"
) -> DataFrame:
    """Score of every row, learned from four fifths of the ids.

    Rows whose crc32 of the id, modulo 5, is 0 are held out.  One row out per row in,
    repeated and NULL ids included.
    """
    rest = remainder(id_col, 5)
    model = fit(docs, labels, rest != 0, id_col, text_col, label)
    scored = docs.select(id_col, (rest == 0).alias("held_out"), score(F.col(text_col), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
