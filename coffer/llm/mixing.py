"""Mixing of sources to target weights by Pareto order sampling.

Each source's target divided by its size says how often a document is taken on average.
The whole part of that is taken of every document; the rest is a Pareto sample: documents
are ranked by random odds over inclusion odds and taken in that order until the words
that the target still wants are reached.  Larger documents are likelier; one factor per source
makes the words expected by the inclusion odds those that are wanted.  Random numbers are
digests of id and text, so reruns agree.  Rows that are equal in all columns have one
rank; where a sample ends among them it takes a counted part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from coffer.llm.frames import WORD, checked_join
from coffer.session import materialise

# A document is taken at most this often.
MOST = 3

WEIGHTS = (1, 2, 3)

# Ranks are cut to this many steps twice, so a cut is found among few rows.
_STEPS = 1 << 16

# Halvings of the interval in which a source's factor lies.
_HALVINGS = 60


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def uniform(seed: str, key: Column) -> Column:
    """Number between 0 and 1 from the digest of ``seed`` and ``key``; a NULL key counts as empty."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 48))


def _source_key(source: Column) -> Column:
    """Text that is equal for equal sources, NULL included."""
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("n"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """``target`` of every source of ``key, source, source_size``.

    Sources in order weigh 1, 2, 3 and so on anew.  Together they are to have as many words
    as there are.  A target stops at ``MOST`` times its source; what is over goes to the
    others by weight.  That is one level for all: a source gets the level times its weight
    or its limit.  Sources are met in the order in which they reach their limits.  The frame
    has a row per source, which is what the windows put in one task.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(order) - 1
    weights = F.array(*[F.lit(float(w)) for w in WEIGHTS])
    weighed = sizes.withColumn("weight", F.element_at(weights, (place % len(WEIGHTS) + 1).cast("int")))
    limit = F.col("source_size") * F.lit(float(MOST))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()).cast("double")
    level = (total - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("weight").over(onward)
    filled = weighed.withColumn("limit", limit).withColumn("level", level)
    # The level is that of the first source which does not reach its limit at it.
    below = F.col("level") * F.col("weight") <= F.col("limit")
    first = F.min(F.when(below, F.struct(F.col("limit") / F.col("weight"), F.col("level").alias("level"))))
    return (
        filled.withColumn("first", first.over(Window.partitionBy()))
        .withColumn("target", F.least("limit", F.col("first.level") * F.col("weight")))
        .select("key", "source", "source_size", "target")
    )


def draw_key(id_col: str, text: Column) -> Column:
    """What a row's random number is drawn from: its id and its text."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.concat(ident, F.lit(":"), F.md5(F.coalesce(text, F.lit("")).cast("binary")))


def size_class(size: Column) -> Column:
    """Number of binary digits of a size."""
    return F.length(F.bin(size))


def class_weight(digits: Column) -> Column:
    """Odds of a document against those of others: the root of its size, rounded to a power."""
    return F.sqrt(F.pow(F.lit(2.0), digits))


def _factor(words: Column, want: Column) -> Column:
    """Factor of the odds at which the words expected are those wanted, by halving an interval.

    ``words`` has the words of a source by size class, in order.  A document of a class has the
    odds factor times weight, and so the chance odds over one plus odds.
    """

    def expected(factor: Column) -> Column:
        def add(total: Column, c: Column) -> Column:
            odds = factor * c["weight"]
            return total + c["words"] * odds / (F.lit(1.0) + odds)

        return F.aggregate(words, F.lit(0.0), add)

    def halved(state: Column, _: Column) -> Column:
        middle = (state["low"] + state["high"]) / F.lit(2.0)
        below = expected(middle) < want
        return F.struct(
            F.when(below, middle).otherwise(state["low"]).alias("low"),
            F.when(below, state["high"]).otherwise(middle).alias("high"),
        )

    start = F.struct(F.lit(0.0).alias("low"), F.col("even").alias("high"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_HALVINGS)), start, halved, lambda s: s["high"])


def odds_factors(rows: DataFrame, sampled: DataFrame) -> DataFrame:
    """``key`` and ``factor`` of every source in ``sampled``; sources without words have none.

    Words are summed by source and size class, of which there are 64 at most.
    """
    classes = rows.filter("size > 0").groupBy("key", size_class(F.col("size")).alias("digits")).agg(
        F.sum("size").cast("double").alias("words")
    )
    classes = classes.select("key", F.struct("digits", class_weight(F.col("digits")).alias("weight"), "words").alias("c"))
    gathered = classes.groupBy("key").agg(F.sort_array(F.collect_list("c")).alias("classes"))
    lightest = F.col("classes")[0]["weight"]
    # With these odds for the lightest class all others are likelier than the share asks for.
    even = F.col("share") / (F.lit(1.0) - F.col("share")) / lightest
    found = gathered.join(sampled, "key").withColumn("even", even)
    return found.select("key", _factor(F.col("classes"), F.col("share") * F.col("source_size")).alias("factor"))


def _rank(key: Column, size: Column, factor: Column, seed: str) -> Column:
    """Pareto rank between 0 and 1: random odds over inclusion odds, folded to a finite range."""
    u = uniform(seed, key)
    # A source of which nothing is left to sample has no factor and no ranks.
    q = F.try_divide(u / (F.lit(1.0) - u), factor * class_weight(size_class(size)))
    return q / (F.lit(1.0) + q)


def _step(level: int) -> Column:
    return F.floor(F.col("rank") * F.lit(float(_STEPS**level))).cast("bigint")


def _cut(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per source where its sample ends: ``key``, ``cut`` (rank and mark of the last equal rows that
    are taken), ``cut_take`` of the ``cut_rows``, and ``last``, ``last_rows`` of the rows of which one more is taken.

    Two rounds of sums over ranks cut to steps narrow each source down to the few rows
    around its cut; only these are put in order, equal rows as one.  The sample takes all rows
    up to the last one with which it does not yet pass what is wanted.  Its last place
    goes to the remaining document whose size is nearest to the words that are still missing.
    """
    running = Window.partitionBy("key").orderBy("step")
    every, missing = rows, wanted
    for level in (1, 2):
        sums = rows.groupBy("key", _step(level).alias("step")).agg(F.sum("size").alias("words"))
        sums = sums.join(missing, "key").withColumn("end", F.sum("words").over(running))
        here = sums.filter((F.col("end") >= F.col("want")) & (F.col("end") - F.col("words") < F.col("want")))
        here = materialise(
            here.select("key", "step", (F.col("want") - F.col("end") + F.col("words")).alias("want")), "steps"
        )
        missing = here.drop("step")
        rows = checked_join(rows, here.select("key", "step"), "key", "inner")
        rows = rows.filter(_step(level) == F.col("step")).drop("step")
    place = F.struct("rank", "mark")
    near = rows.groupBy("key", place.alias("place"), "size").agg(F.count(F.lit(1)).alias("n")).join(missing, "key")
    order = Window.partitionBy("key").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    near = near.withColumn("end", F.sum(F.col("size") * F.col("n")).over(order))
    # Equal rows of which some fit: all, or as many as words are wanted.
    left = F.col("want") - F.col("end") + F.col("size") * F.col("n")
    take = F.least("n", F.floor(left / F.col("size"))).cast("bigint")
    near = near.filter(left >= 0).withColumns({"take": take, "gap": left - take * F.col("size")})
    ended = near.groupBy("key").agg(
        F.max_by(F.struct("place", "take", "n", "gap"), "place").alias("last"),
    )
    cut = materialise(
        ended.select(
            "key",
            F.col("last.place").alias("cut"),
            F.col("last.take").alias("cut_take"),
            F.col("last.n").alias("cut_rows"),
            F.col("last.gap").alias("gap"),
        ),
        "cuts",
    )
    after = (place > F.col("cut")) | ((place == F.col("cut")) & (F.col("cut_take") < F.col("cut_rows")))
    off = F.abs(F.col("size") - F.col("gap"))
    last = (
        checked_join(every, cut.select("key", "cut", "cut_take", "cut_rows", "gap"), "key", "inner")
        .filter(after & (off < F.col("gap")))
        .groupBy("key", place.alias("last"), off.alias("off"))
        .agg(F.count(F.lit(1)).alias("last_rows"))
        .groupBy("key")
        .agg(F.min(F.struct("off", "last", "last_rows")).alias("m"))
    )
    return cut.drop("gap").join(last.select("key", "m.last", "m.last_rows"), "key", "left")


def mixture(
    docs: DataFrame,
    size: Column,
    draw: Column,
    source_col: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """Per source: ``key``, ``source_size``, ``target``, ``whole`` and where its sample ends.

    ``size`` is the number of words of a row and ``draw`` what its random number is drawn from,
    both computed once here.  The result grows with the number of sources alone; a source has
    a row whatever its documents.
    """
    narrow = materialise(
        docs.select(
            draw.alias("draw"),
            _source_key(F.col(source_col)).alias("key"),
            F.col(source_col).alias("source"),
            size.alias("size"),
            _mark(docs).alias("mark"),
        ),
        "sizes",
    )
    sizes = narrow.groupBy("key").agg(F.any_value("source").alias("source"), F.sum("size").alias("source_size"))
    targets = source_targets(materialise(sizes, "source_sizes"))
    often = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    targets = targets.withColumn("whole", F.least(F.floor(often), F.lit(MOST)).cast("bigint")).withColumn(
        "share", F.greatest(often - F.col("whole"), F.lit(0.0))
    )
    targets = materialise(targets, "targets")
    sampled = targets.filter(f"share > 0 AND whole < {MOST}").select("key", "share", "source_size")
    factors = materialise(odds_factors(narrow, sampled), "factors")
    ranked = checked_join(narrow.filter("size > 0"), factors, "key", "inner")
    ranked = ranked.select(
        "key", "mark", "size", _rank(F.col("draw"), F.col("size"), F.col("factor"), seed).alias("rank")
    )
    want = sampled.select("key", (F.col("share") * F.col("source_size")).alias("want"))
    found = targets.join(factors, "key", "left").join(_cut(ranked, want), "key", "left")
    return materialise(found, "mixture")


def _mark(docs: DataFrame) -> Column:
    """Tells rows apart that differ in any column."""
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return F.struct(F.xxhash64(*columns).alias("m1"), F.xxhash64(F.lit("mark"), *columns).alias("m2"))


def with_copies(
    docs: DataFrame,
    plan: DataFrame,
    size: Column,
    draw: Column,
    out: str = "copies",
    source_col: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with the number of copies to take and the row of ``plan``, in the columns
    ``out`` and ``out_plan``, which must be new.

    While the table of sources is small every task has it, and no row of ``docs`` moves,
    so a source of any size stays spread out.  Only where a sample ends among rows that are
    equal in all columns are these counted and dealt out anew: so many with the copy more, the rest
    without.
    """
    key, own = f"{out}_key", f"{out}_plan"
    at = lambda c: F.col(f"{own}.{c}")
    place = F.struct(_rank(draw, size, at("factor"), seed).alias("rank"), _mark(docs).alias("mark"))
    keyed = docs.withColumn(key, _source_key(F.col(source_col)))
    sources = plan.select(F.col("key").alias(key), F.struct(*plan.columns).alias(own))
    placed = checked_join(keyed, sources, key, "left").drop(key)

    # Of equal rows around the cut: how many are there, and how many of them have the copy more.
    at_cut, at_last = place == at("cut"), place == at("last")
    more = F.when(at_cut, at("cut_take")).otherwise(0) + F.when(at_last, 1).otherwise(0)
    among = F.when(at_cut, at("cut_rows")).when(at_last, at("last_rows"))
    before = place < at("cut")
    state = f"{out}_state"
    judged = placed.withColumn(
        state,
        # One value on: a row's draw is worked out once.
        F.explode(F.array(F.struct(F.coalesce(before, F.lit(False)).alias("before"), F.coalesce(more, F.lit(0)).alias("more"), among.alias("among")))),
    )
    extra = F.col(f"{state}.before") | (F.col(f"{state}.more") > 0)
    copies = F.when(size > 0, at("whole") + extra.cast("bigint")).otherwise(F.lit(0)).cast("bigint")
    if plan.filter("cut_take < cut_rows OR last_rows > 1").isEmpty():
        return judged.withColumn(out, copies).drop(state)
    split = F.coalesce(F.col(f"{state}.among") > F.col(f"{state}.more"), F.lit(False)) & ~F.col(f"{state}.before")
    split = split & (F.col(f"{state}.more") > 0)
    whole = judged.filter(~split).withColumn(out, copies).drop(state)
    equal = judged.filter(split).groupBy(*[f"`{c}`" for c in docs.columns]).agg(
        F.count(F.lit(1)).alias(f"{out}_n"), F.any_value(own).alias(own), F.any_value(f"{state}.more").alias(f"{out}_more")
    )
    dealt = equal.withColumn(f"{out}_i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(f"{out}_n"))))
    taken = at("whole") + (F.col(f"{out}_i") <= F.col(f"{out}_more")).cast("bigint")
    return whole.unionByName(dealt.withColumn(out, taken.cast("bigint")).select(*whole.columns))


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` of every row.

    Size is the number of words, 0 for NULL and texts of white space; such rows take
    nothing.  NULL sources are one source, last in order.  Rows that share an id draw
    numbers of their own as long as their texts differ; of rows equal in id, text and
    source some may be taken once more than others.  No rows give no rows.
    """
    text = F.col(text_col)
    narrow = materialise(
        docs.select(id_col, source_col, word_count(text).alias("size"), draw_key(id_col, text).alias("__draw")), "words"
    )
    size, draw = F.col("size"), F.col("__draw")
    out = with_copies(narrow, mixture(narrow, size, draw, source_col), size, draw, "copies", source_col)
    return out.select(
        id_col,
        "size",
        F.col("copies_plan.source_size").alias("source_size"),
        F.col("copies_plan.target").alias("target"),
        (size * F.col("copies")).alias("taken"),
    )


def repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it.

    NULLs, empty texts and repeated rows as in ``mixed_documents``; rows are equal when they
    are in all columns.
    """
    # Unfolded from an array, numbers are worked out once and not again wherever they are used.
    own = F.struct(word_count(F.col(text_col)).alias("size"), draw_key(id_col, F.col(text_col)).alias("draw"))
    sized = docs.withColumn("__own", F.explode(F.array(own)))
    size, draw = F.col("__own.size"), F.col("__own.draw")
    out = with_copies(sized, mixture(sized, size, draw, source_col), size, draw, "__copies", source_col)
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__copies")))
    return out.filter("__copies > 0").withColumn("__copy", times).select(*[f"`{c}`" for c in docs.columns])
