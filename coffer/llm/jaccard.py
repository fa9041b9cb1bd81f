"""Similarity join of texts on their word shingles, by PartEnum signatures.

Two sets with a Jaccard similarity of at least ``t`` have sizes within a factor ``t`` and
differ in at most ``(1 - t) / (1 + t) * (|A| + |B|)`` elements.  Sizes are cut into bands; a
set takes part in its own band and in the span around the nearest border of bands, so two
sets that may match meet in one of both.  In each, the domain of shingles is hashed to
partitions, and each partition to ``PARTS`` parts.  There are more partitions than sets
that match can spoil: in one of them at most ``LEAVE`` elements differ, so some subset of
``PARTS - LEAVE`` of its parts is equal.  The hashes of all such subsets are the
signatures; sets that share one are compared.

Subsets without elements would be shared by unrelated sets.  They give no signature: spare
partitions make up for them.  A set that still has too few full partitions gives the
signatures of another deal as well, to as many partitions as the smallest sets of its band
fill best.  Of two similar sets, the one that has enough full partitions first decides: up
to that deal both give all signatures.

Before sets are compared, parities are, 1024 at first and 4096 then: each holds whether a set
has an odd number of the elements hashed to it, so two sets differ in at least as many
elements as parities.  This refutes most pairs that share a passage only, and never a pair
that matches.
"""

from __future__ import annotations

import math
from itertools import combinations, count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coffer.llm.components import connected_components
from coffer.llm.frames import bounded_batches, checked_join
from coffer.llm.words import Texts, equal_runs, mix, slices, windows
from coffer.session import materialise

# Width of a band of sizes.
BAND = 1.5625

# Parts of a partition, and how many of them a subset leaves out.
PARTS, LEAVE = 2, 1

# Spare partitions, as a share and a number.
SPARE, SPARE_MORE = 0.16, 1

# Words of 64 parities: of every set, and of those that share a signature.
PARITY_WORDS, MORE_PARITY_WORDS = 16, 64

# Signatures of each set that are compared pair by pair first.
FEW = 16

_PARITIES = [f"p{i}" for i in range(PARITY_WORDS)]

_U64 = np.uint64


def shingle_sets(t: Texts, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles as hashes, ordered by text, and the text of each.

    A text with fewer than ``width`` words has its whole sequence as one shingle.
    """
    low = t.lower()
    starts, ends = low.words()
    owner, h = low.text_of(starts), low.hashes(starts, ends)
    grams, at = windows(h, owner, width)
    texts = owner[at]
    n = np.bincount(owner, minlength=len(t))
    for few in range(1, width):
        short = np.flatnonzero(n == few)
        if len(short):
            first = np.searchsorted(owner, short)
            total = np.full(len(short), few, dtype=np.uint64)
            for i in range(few):
                total = mix(total * _U64(0x9E3779B97F4A7C15) + h[first + i])
            grams, texts = np.concatenate([grams, total]), np.concatenate([texts, short])
    order, same = equal_runs(texts, grams)
    order = order[~same]
    return grams[order], texts[order]


Plan = list[tuple[int, int, int, int, int]]


def _roomy(least: int, enough: int) -> int:
    """Partitions of which a set of ``least`` elements most surely fills ``enough``.

    The expected number of full ones less three deviations, over the numbers from ``enough`` on.
    """

    def surely(n: int) -> float:
        full = (1.0 - (1.0 - 1.0 / (n * PARTS)) ** least) ** PARTS
        return n * full - 3.0 * math.sqrt(n * full * (1.0 - full)) - enough

    return max((enough + k * max(enough // 50, 1) for k in range(60)), key=surely)


def band_plan(percent: int) -> Plan:
    """For each group of sizes: least and largest size, partitions of the first deal and of those
    after it, full ones that suffice.

    Even places are bands, odd ones the spans around the border to the next band: from the
    least size that may match the first size beyond to the largest that may match the last
    below.  Groups in which no two different sets can match have no partitions.
    """
    plan, low = [], 1
    while low < 1 << 40:
        high = int(low * BAND)
        over = high * 100 // percent
        for least, most, total in ((low, high, 2 * high), (-(-(high + 1) * percent // 100), over, high + over)):
            distance = total * (100 - percent) // (100 + percent)
            enough = distance // (LEAVE + 1) + 1
            first = math.ceil(enough * (1 + SPARE)) + SPARE_MORE
            plan.append((least, most, *((first, _roomy(least, enough)) if distance else (0, 0)), enough))
        low = high + 1
    return plan


def signatures(shingles: np.ndarray, percent: int, plan: Plan) -> np.ndarray:
    """Signatures of one set in all groups of sizes that it belongs to."""
    size = len(shingles)
    own = next(i for i in range(0, len(plan), 2) if size <= plan[i][1])
    subsets = list(combinations(range(PARTS), PARTS - LEAVE))
    out = []
    for group in range(max(own - 1, 0), own + 2):
        least, most, first, later, enough = plan[group]
        if not first or not least <= size <= most:
            continue
        for deal in count():
            n = later if deal else first
            tag = _U64((group << 16) | (deal << 4))
            place = mix(shingles ^ mix(np.array([tag], dtype=np.uint64)))
            cell = ((place >> _U64(32)) % _U64(n * PARTS)).astype(np.int64)
            sums = np.zeros(n * PARTS, dtype=np.uint64)
            np.add.at(sums, cell, mix(place + _U64(1)))
            full = (np.bincount(cell, minlength=n * PARTS) > 0).reshape(n, PARTS)
            sums = sums.reshape(n, PARTS)
            number = mix(np.arange(n, dtype=np.uint64) + (tag << _U64(20)))
            good = np.ones(n, dtype=bool)
            for k, subset in enumerate(subsets):
                some = full[:, subset].any(axis=1)
                key = number + _U64(k)
                for part in subset:
                    key = mix(key + sums[:, part])
                out.append(key[some])
                good &= some
            if good.sum() >= enough:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parities(sets: np.ndarray, texts: np.ndarray, n: int, words: int = PARITY_WORDS) -> np.ndarray:
    """For each of ``n`` texts, whether its elements in each of ``64 * words`` cells are odd in number."""
    cells = 64 * words
    cell = ((mix(sets ^ _U64(0x2545F4914F6CDD1D)) >> _U64(32)) % _U64(cells)).astype(np.int64)
    out = np.zeros((n, words), dtype=np.int64)
    some = max(1, (1 << 20) // cells)  # a million counts at once
    for begin in range(0, n, some):
        end = min(begin + some, n)
        low, high = np.searchsorted(texts, [begin, end])
        counts = np.bincount((texts[low:high] - begin) * cells + cell[low:high], minlength=(end - begin) * cells)
        odd = (counts.reshape(end - begin, cells) & 1).astype(bool)
        out[begin:end] = np.packbits(odd, axis=1).view(np.int64)
    return out


def _profiles(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``id``, ``n``, a 128-bit mark and the parities of the shingle set of every row."""

    def rows(batches):
        for batch in batches:
            done = 0
            for t in slices(batch.column("text")):
                sets, texts = shingle_sets(t, width)
                n = np.bincount(texts, minlength=len(t))
                f1, f2 = np.zeros(len(t), dtype=np.uint64), np.zeros(len(t), dtype=np.uint64)
                np.add.at(f1, texts, mix(sets + _U64(11)))
                np.add.at(f2, texts, mix(sets ^ _U64(0x5851F42D4C957F2D)))
                odd = parities(sets, texts, len(t))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").slice(done, len(t)),
                        pa.array(n.astype(np.int64)),
                        pa.array(f1.view(np.int64)),
                        pa.array(f2.view(np.int64)),
                        *(pa.array(np.ascontiguousarray(odd[:, i])) for i in range(PARITY_WORDS)),
                    ],
                    ["id", "n", "f1", "f2", *_PARITIES],
                )
                done += len(t)

    narrow = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"{c} bigint" for c in ("id", "n", "f1", "f2", *_PARITIES))
    return narrow.mapInArrow(rows, kinds)


def _signed(width: int, percent: int, plan: Plan):
    """Signatures of the set of each text, as a function over Arrow batches."""

    def rows(batches):
        for batch in batches:
            for ids, sets in _sets(batch, width):
                made = [signatures(own, percent, plan) for own in sets]
                at = np.repeat(np.arange(len(made)), [len(m) for m in made])
                if len(at):
                    values = pa.array(np.concatenate(made).view(np.int64))
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), values], ["id", "sig"])

    return rows


def _with_parities(width: int):
    """The set of each text and its parities, as a function over Arrow batches."""

    def rows(batches):
        for batch in batches:
            for ids, sets in _sets(batch, width):
                ends = np.concatenate(([0], np.cumsum([len(own) for own in sets])))
                values = np.concatenate(sets)
                texts = np.repeat(np.arange(len(sets)), np.diff(ends))
                odd = parities(values, texts, len(sets), MORE_PARITY_WORDS)
                odd_ends = np.arange(len(sets) + 1) * MORE_PARITY_WORDS
                lists = [
                    pa.ListArray.from_arrays(pa.array(e.astype(np.int32)), pa.array(v))
                    for e, v in ((ends, values.view(np.int64)), (odd_ends, odd.ravel()))
                ]
                yield pa.RecordBatch.from_arrays([ids, *lists], ["id", "shingles", "odd"])

    return rows


def _sets(batch: pa.RecordBatch, width: int):
    """Ids and sets of the texts that have a word, some texts at a time."""
    ids, done = batch.column("id"), 0
    for t in slices(batch.column("text")):
        sets, texts = shingle_sets(t, width)
        at = np.searchsorted(texts, np.arange(len(t) + 1))
        own = np.flatnonzero(np.diff(at))
        if len(own):
            yield ids.slice(done, len(t)).take(pa.array(own)), [sets[at[i] : at[i + 1]] for i in own]
        done += len(t)


def _may_match(left: str, right: str, percent: int) -> Column:
    """False only for pairs that sizes or parities refute; columns are structs of both."""
    a, b = F.col(f"{left}.n"), F.col(f"{right}.n")
    apart = sum((F.bit_count(F.col(f"{left}.{p}").bitwiseXOR(F.col(f"{right}.{p}"))) for p in _PARITIES), F.lit(0))
    sizes = F.least(a, b) * 100 >= F.greatest(a, b) * percent
    return sizes & (apart * (100 + percent) <= (a + b) * (100 - percent))


def _verified(pairs: DataFrame, marks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` whose sets are similar enough.

    Sizes and parities come first, which are small; sets follow for what is left.  The set
    of ``b`` goes to ``a``, which is the id that many pairs share.
    """

    def joined(rows: DataFrame, table: DataFrame, value: str) -> DataFrame:
        for end in ("b", "a"):
            rows = rows.join(table.select(F.col("id").alias(end), F.col(value).alias(f"{value}_{end}")), end)
        return rows

    near = joined(pairs, marks, "mark").filter(_may_match("mark_a", "mark_b", percent))
    near = materialise(near.select("a", "b", "mark_a.n", F.col("mark_b.n").alias("m")).distinct(), "near_pairs")
    differ = F.zip_with("odd_a", "odd_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differ, F.lit(0), lambda total, x: total + x)
    near = joined(near, sets, "odd").filter(apart * (100 + percent) <= (F.col("n") + F.col("m")) * (100 - percent))
    near = materialise(near.select("a", "b").distinct(), "near_pairs")

    with_b = checked_join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), near, "b", "inner")
    heads = materialise(near.select("a").distinct(), "heads")
    with_a = checked_join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), heads, "a", "left_semi")
    shared = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - shared
    return with_b.join(with_a, "a").filter(shared * 100 >= union * percent).select("a", "b")


def similar_documents(
    docs: DataFrame, percent: int = 80, width: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` for every row.

    Texts are linked when their sets of ``width``-word shingles have a Jaccard similarity
    of at least ``percent`` hundredths; A-Z count as lower case.  ``component_id`` is the
    least id reachable by links.  Texts without a word, and NULL, link with nothing.
    Rows without an id take the component of an equal set that has one, or NULL.  Rows
    that share an id count as one document with several texts.

    Equal sets are one from the start, so copies give no signature.  Sets that share a
    signature are first compared with the least and the greatest id of those they share
    one with; only pairs that are still in different components, and that sizes and
    parities do not refute, then meet each other.
    """
    bounded_batches(docs.sparkSession)
    profiles = materialise(_profiles(docs, id_col, text_col, width), "profiles")
    mark = ["n", "f1", "f2"]
    groups = materialise(
        profiles.filter("n > 0")
        .groupBy(*mark)
        .agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("rows"), *[F.any_value(p).alias(p) for p in _PARITIES]),
        "equal_sets",
    )
    candidates = materialise(_candidates(docs, profiles, groups, percent, width, id_col, text_col), "candidates")
    candidates = materialise(_distinct_groups(candidates), "candidates")
    marks = groups.filter("rep IS NOT NULL").select(F.col("rep").alias("id"), F.struct("n", *_PARITIES).alias("mark"))
    components = _linked(docs, candidates, marks, percent, width, id_col, text_col)

    final = groups.join(components.withColumnRenamed("node", "rep"), "rep", "left").select(
        *mark, "rows", F.coalesce("component", "rep").alias("component")
    )
    # A set that is neither repeated nor linked keeps its own id.
    final = final.join(groups.select(*mark, "rep"), mark).filter("rows > 1 OR component <> rep").select(*mark, "component")
    return profiles.join(final, mark, "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )


def _candidates(docs, profiles, groups, percent, width, id_col, text_col) -> DataFrame:
    """``sig``, ``id``, ``first``, ``last``: sets that share a signature with another."""
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    spare = profiles.filter("id IS NOT NULL AND n > 0").join(
        groups.filter("rows > 1").select("n", "f1", "f2", "rep"), ["n", "f1", "f2"]
    )
    # Ids all of whose texts are copies of a lower id.
    copies = spare.filter("id <> rep").select("id").distinct()
    copies = materialise(copies.join(groups.select(F.col("rep").alias("id")), "id", "left_anti"), "copies")
    alone = checked_join(texts.filter("id IS NOT NULL AND text IS NOT NULL"), copies, "id", "left_anti")
    plan = band_plan(percent)
    signed = alone.mapInArrow(_signed(width, percent, plan), "id bigint, sig bigint")
    same = Window.partitionBy("sig")
    ends = signed.withColumn("first", F.min("id").over(same)).withColumn("last", F.max("id").over(same))
    return ends.filter("first < last")


def _distinct_groups(candidates: DataFrame) -> DataFrame:
    """Candidates of one signature for each set of members: similar texts share many signatures.

    Members are told by their number and a 128-bit sum of their hashes.
    """
    hashes = [F.expr(f"bit_xor(xxhash64({salt}, id))").alias(f"h{salt}") for salt in (1, 2)]
    members = candidates.groupBy("sig").agg(F.count(F.lit(1)).alias("n"), *hashes)
    kept = members.groupBy("n", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig")
    return checked_join(candidates, materialise(kept, "signatures"), ["sig"], "left_semi")


def _linked(docs, candidates, marks, percent, width, id_col, text_col) -> DataFrame:
    """Components of the candidates."""
    ids = materialise(candidates.select("id").distinct(), "candidate_ids")
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text"))
    marks = materialise(marks.join(ids, "id", "left_semi"), "marks")
    sets = materialise(
        checked_join(texts.filter("text IS NOT NULL"), ids, "id", "left_semi").mapInArrow(
            _with_parities(width), "id bigint, shingles array<bigint>, odd array<bigint>"
        ),
        "sets",
    )

    def verified(pairs: DataFrame) -> DataFrame:
        return _verified(materialise(pairs, "pairs"), marks, sets, percent)

    def pairs(end: str, rows: DataFrame) -> DataFrame:
        """One pair per set: with the least first, or the least last id of all its signatures."""
        return rows.filter(F.col("id") != F.col(end)).groupBy(F.col("id").alias("b")).agg(F.min(end).alias("a"))

    ends = pairs("first", candidates).unionByName(pairs("last", candidates)).distinct()
    parts = materialise(connected_components(verified(ends), "a", "b"), "parts")

    # What is still apart is compared pair by pair, as far as sizes and parities allow.  Pairs that
    # nearly match share most signatures, so the few least of each set find nearly all of them; what
    # follows compares those alone that share none of these, and so no pair a second time.
    least = Window.partitionBy("id").orderBy("sig")
    placed = materialise(_open(candidates, parts, marks), "open")
    some = placed.withColumn("place", F.row_number().over(least)).filter(F.col("place") <= FEW).drop("place")
    some = materialise(some, "few_signatures")
    parts = _joined(parts, verified(_met(some, F.lit(True), percent)))

    few = some.groupBy("id").agg(F.collect_list("sig").alias("few"))
    known = materialise(marks.join(few, "id").select("id", "mark", "few"), "marks")
    rest = materialise(_open(candidates, parts, known), "open")
    return _joined(parts, verified(_met(rest, ~F.arrays_overlap("few_a", "few_b"), percent)))


def _met(rows: DataFrame, more: Column, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` of different components that share a signature and may match."""
    named = lambda end: [F.col(c).alias("sig" if c == "sig" else f"{c}_{end}") for c in rows.columns]
    apart = (F.col("id_a") < F.col("id_b")) & (F.col("part_a") != F.col("part_b"))
    both = rows.select(*named("a")).join(rows.select(*named("b")).withColumnRenamed("sig", "sig_b"), F.col("sig") == F.col("sig_b"))
    met = both.filter(apart & _may_match("mark_a", "mark_b", percent) & more)
    return met.select(F.col("id_a").alias("a"), F.col("id_b").alias("b")).distinct()


def _joined(parts: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: each node's way to its component stands for the links before."""
    links = materialise(links, "links")
    if links.isEmpty():
        return parts
    ways = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
    return materialise(connected_components(ways.unionByName(links), "a", "b"), "parts")


def _apart(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """Candidates that are not in the component of the least id of their signature."""
    own = parts.select(F.col("node").alias("id"), F.col("component").alias("part"))
    other = parts.select(F.col("node").alias("first"), F.col("component").alias("first_part"))
    rows = checked_join(checked_join(candidates, own, "id", "left"), other, "first", "left")
    return rows.filter(F.coalesce("part", "id") != F.coalesce("first_part", "first"))


def _open(candidates: DataFrame, parts: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows of signatures that still join different components, with sizes and parities."""
    open_signatures = materialise(_apart(candidates, parts).select("sig").distinct(), "open_signatures")
    rows = checked_join(candidates.select("sig", "id"), open_signatures, "sig", "left_semi")
    own = parts.select(F.col("node").alias("id"), F.col("component").alias("part"))
    rows = checked_join(rows, own, "id", "left").withColumn("part", F.coalesce("part", "id"))
    return checked_join(rows, marks, "id", "inner")
