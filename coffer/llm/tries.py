"""Trie of conversations by their first turns, with totals of every subtree.

A node is a sequence of turns with which conversations start.  Its key is the exclusive or of
128-bit digests of its turns, each taken with its place; so the key of its parent is found by
taking out the last turn.  Keys along a conversation are running values, worked out in blocks
of places, so a conversation of any length is spread over tasks.

Totals come from parallel tree contraction.  A round takes two kinds of nodes out of what is
left of the tree.  Compress: of nodes with one child, some that do not touch each other are
taken out; the child moves up and its edge remembers what was passed over.  Rake: leaves hand
their totals to their parents.  Half of a chain goes in a round, so there are about as many
rounds as the longest chain has binary digits.  The nodes that were passed over get their
totals afterwards, last round first, from the child that each had then.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coffer.llm.frames import WORD, checked_join
from coffer.operators.ranking import part_offsets
from coffer.session import materialise

# Conversations that share their first turns, and how many of these at most.
FAMILY, HEADS = 20, 4

# Places of a conversation whose running keys are worked out together.
BLOCK = 1 << 16

_KEY = ["depth", "k1", "k2"]


def numbered_turns(
    conversations: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv``, global ``number`` in order of conversation and turn, digests ``h1``, ``h2`` and ``words`` of every turn.

    NULL turns come first; turns with equal numbers go by role and text.  NULL role or text
    counts as empty.  Rows without a conversation are left out.  Turns are range-partitioned,
    so a conversation of any length fills as many tasks as it needs.
    """
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.col(turn_col).alias("turn"),
        text(role_col).alias("role"),
        text(text_col).alias("text"),
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "text")]
    parts = materialise(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_pos"),
            "conv",
            F.xxhash64(F.lit(1), "role", "text").alias("h1"),
            F.xxhash64(F.lit("second"), "text", "role").alias("h2"),
            F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"),
        ),
        "turns",
    )
    # One row per shuffle partition.
    offsets = F.broadcast(part_offsets(parts, F.count(F.lit(1))))
    return parts.join(offsets, "_part").select("conv", (F.col("_offset") + F.col("_pos")).alias("number"), "h1", "h2", "words")


def rebuilt_turns(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns of conversations whose first ones come from the first of their family.

    Conversation ``c`` gets the first ``h`` turns of ``c - c % family``, then its own after its
    first ``h``, where ``h`` is the checksum of ``c`` modulo ``heads``.  Returned are
    ``conv, length`` of every conversation and ``conv, length, place, h1, h2, words`` of every turn.
    """
    convs = turns.groupBy("conv").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    head = (F.crc32(F.col("conv").cast("string").cast("binary")) % heads).alias("head")
    convs = materialise(convs.select("*", head, (F.col("conv") - F.col("conv") % family).alias("base")), "conversations")
    bases = convs.filter("conv = base").select("base", F.col("n").alias("n_base"))
    given = F.least("head", F.coalesce("n_base", F.lit(0))).alias("given")
    convs = materialise(convs.join(bases, "base", "left").select("conv", "first", "base", "head", given, "n"), "conversations")
    length = F.col("given") + F.greatest(F.col("n") - F.col("head"), F.lit(0))
    convs = convs.withColumn("length", length)

    rows = turns.join(convs, "conv").withColumn("at", F.col("number") - F.col("first"))
    mark = ["h1", "h2", "words"]
    own = rows.filter("at >= head").select("conv", "length", (F.col("at") - F.col("head") + F.col("given")).alias("place"), *mark)
    first = rows.filter((F.col("conv") == F.col("base")) & (F.col("at") < heads - 1))
    first = materialise(first.select("base", F.col("at").alias("place"), *mark), "heads")
    taken = convs.select("base", "conv", "length", "given").join(first, "base").filter("place < given")
    return convs.select("conv", "length"), own.unionByName(taken.select("conv", "length", "place", *mark))


def _running(turns: DataFrame) -> DataFrame:
    """``conv, length, depth, k1, k2, p1, p2, words``: keys of each turn's node and of its parent."""
    placed = turns.select(
        "conv",
        "length",
        "place",
        F.expr(f"place div {BLOCK}").alias("block"),
        F.xxhash64("h1", "place").alias("s1"),
        F.xxhash64("h2", F.lit("place"), "place").alias("s2"),
        "words",
    )
    block = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    rows = materialise(placed.withColumns({f"r{i}": F.expr(f"bit_xor(s{i})").over(block) for i in (1, 2)}), "running")
    # The last place of a full block has its total; only long conversations have one.
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    full = rows.filter(F.col("place") % BLOCK == BLOCK - 1)
    carried = full.select(
        "conv", (F.col("block") + 1).alias("block"), *[F.expr(f"bit_xor(r{i})").over(before).alias(f"c{i}") for i in (1, 2)]
    )
    rows = checked_join(rows, materialise(carried, "carried"), ["conv", "block"], "left")
    keys = [F.col(f"r{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in (1, 2)]
    return rows.select(
        "conv",
        "length",
        (F.col("place") + 1).alias("depth"),
        *[k.alias(f"k{i}") for i, k in enumerate(keys, 1)],
        *[k.bitwiseXOR(F.col(f"s{i}")).alias(f"p{i}") for i, k in enumerate(keys, 1)],
        "words",
    )


def _ends(rows: DataFrame) -> DataFrame:
    """``depth, k1, k2, ends_sha256`` of nodes at which conversations end: the digest of their ids in order.

    Rows in order are cut to strings of a batch each.  Where a node's ids lie in one string
    that is all.  A node that goes on from batch to batch has its few strings put in order
    and digested as a stream, since a digest has to see all bytes one after the other.
    """
    order = [*_KEY, "conv"]

    def joined(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            changed = [pc.not_equal(batch.column(c).slice(1), batch.column(c).slice(0, n - 1)) for c in _KEY]
            cuts = [0, *(pc.indices_nonzero(reduce(pc.or_, changed)).to_numpy() + 1).tolist(), n]
            runs = len(cuts) - 1
            ids = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), batch.column("conv").cast(pa.string()))
            heads = pa.array(cuts[:-1])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(heads) for c in _KEY),
                    pa.array([part] * runs, pa.int64()),
                    pa.array(range(number, number + runs), pa.int64()),
                    pa.array([0 < i < runs - 1 for i in range(runs)]),
                    pc.binary_join(ids, ","),
                ],
                [*_KEY, "part", "number", "whole", "ids"],
            )
            number += runs

    keys = "depth bigint, k1 bigint, k2 bigint"
    sorted_rows = rows.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    strings = materialise(
        sorted_rows.mapInArrow(joined, f"{keys}, part bigint, number bigint, whole boolean, ids string"), "ends"
    )
    kind = pa.schema([*((c, pa.int64()) for c in _KEY), ("ends_sha256", pa.string())])

    def digested(batches):
        key = digest = None
        for batch in batches:
            done = []
            for *now, ids in zip(*(batch.column(c).to_pylist() for c in (*_KEY, "ids"))):
                if now == key:
                    digest.update(b"," + ids.encode())
                    continue
                if key:
                    done.append([*key, digest.hexdigest()])
                key, digest = now, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, r)) for r in done], kind)
        if key:
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, [*key, digest.hexdigest()]))], kind)

    whole = strings.filter("whole").select(*_KEY, F.sha2(F.col("ids").cast("binary"), 256).alias("ends_sha256"))
    split = strings.filter("NOT whole").repartition(*_KEY).sortWithinPartitions(*_KEY, "part", "number")
    return whole.unionByName(split.select(*_KEY, "ids").mapInArrow(digested, f"{keys}, ends_sha256 string"))


def _messages(rows: DataFrame, weights: list[str], first: bool = False) -> DataFrame:
    """The tree after leaves were raked: every node's own row and what its children tell it.

    Columns: ``conv, depth`` (the node), ``up_conv, up_depth`` (its parent; NULL for the root),
    ``kids`` and, where that is 1, ``kid_conv, kid_depth``; per weight what the node has so far,
    what its edge to the parent carries (``e_``) and what the edges of its children do (``k_``).
    """
    leaf = F.lit(False) if first else (F.col("kids") == 0) & F.col("up_conv").isNotNull()
    own = ["up_conv", "up_depth", *[f"e_{w}" for w in weights]]
    none = F.lit(None).cast("bigint")
    zero = F.lit(0).cast("bigint")
    stays = F.struct(
        "conv", "depth", *own, *weights, zero.alias("kids"), none.alias("kid_conv"), none.alias("kid_depth"),
        *[zero.alias(f"k_{w}") for w in weights],
    )
    tells = F.struct(
        F.col("up_conv").alias("conv"),
        F.col("up_depth").alias("depth"),
        *[none.alias(c) for c in own],
        *[F.when(leaf, F.col(w) + F.col(f"e_{w}")).otherwise(zero).alias(w) for w in weights],
        F.when(leaf, zero).otherwise(F.lit(1)).cast("bigint").alias("kids"),
        F.when(~leaf, F.col("conv")).alias("kid_conv"),
        F.when(~leaf, F.col("depth")).alias("kid_depth"),
        *[F.when(leaf, zero).otherwise(F.col(f"e_{w}")).alias(f"k_{w}") for w in weights],
    )
    sent = rows.select(F.explode(F.array(F.when(~leaf, stays), F.when(F.col("up_conv").isNotNull(), tells))).alias("m"))
    sums = [*weights, "kids", *[f"k_{w}" for w in weights]]
    return (
        sent.filter("m IS NOT NULL")
        .select("m.*")
        .groupBy("conv", "depth")
        .agg(*[F.max(c).alias(c) for c in own], *[F.sum(c).alias(c) for c in sums], F.min("kid_conv").alias("kid_conv"), F.min("kid_depth").alias("kid_depth"))
    )


def _passed_over(digit: int, flipped: bool) -> Column:
    """Whether compress takes a node out: no two that are parent and child, whatever the digit."""
    bit = lambda c: F.getbit(F.col(c), F.lit(digit)) != int(flipped)
    return (F.col("kids") == 1) & F.col("up_conv").isNotNull() & bit("depth") & ~bit("kid_depth")


def subtree_totals(tree: DataFrame, weights: list[str]) -> DataFrame:
    """``conv, depth, kids`` of every node of ``tree``, and per weight the sum over its subtree.

    ``tree`` has ``conv, depth, up_conv, up_depth`` and the weights; besides, ``leaves`` counts
    the nodes of a subtree that have no child.  Parents are less deep than children; the root's
    parent is NULL.
    """
    sums = ["leaves", *weights]
    zero = F.lit(0).cast("bigint")
    start = tree.withColumn("leaves", zero).withColumns({f"e_{w}": zero for w in sums})
    now = _messages(start, sums, first=True).withColumn("leaves", (F.col("kids") == 0).cast("bigint"))
    now = whole = materialise(now, "tree")
    digits = max((now.agg(F.max("depth")).first()[0] or 0).bit_length(), 1)
    rounds = []
    while True:
        gone = _passed_over(len(rounds) % digits, len(rounds) // digits % 2 == 1)
        left, n_gone = now.agg(F.count_if(F.col("kids") > 0), F.count_if(gone)).first()
        rounds.append((now, gone, n_gone))
        if not left:
            break
        kept = now
        if n_gone:
            over = now.filter(gone).select(
                F.col("kid_conv").alias("conv"),
                F.col("kid_depth").alias("depth"),
                F.struct("up_conv", "up_depth", *[(F.col(w) + F.col(f"e_{w}")).alias(w) for w in sums]).alias("over"),
            )
            moved = F.col("over").isNotNull()
            kept = now.filter(~gone).join(over, ["conv", "depth"], "left").withColumns(
                {f"up_{c}": F.when(moved, F.col(f"over.up_{c}")).otherwise(F.col(f"up_{c}")) for c in ("conv", "depth")}
                | {f"e_{w}": F.col(f"e_{w}") + F.coalesce(f"over.{w}", zero) for w in sums}
            )
        now = materialise(_messages(kept, sums), "tree")

    known = None
    for table, gone, n_gone in reversed(rounds):
        done = table.filter("kids = 0").select("conv", "depth", *sums)
        known = known.unionByName(done) if known else done
        if n_gone:
            below = known.select(F.col("conv").alias("kid_conv"), F.col("depth").alias("kid_depth"), F.struct(*sums).alias("below"))
            totals = table.filter(gone).join(below, ["kid_conv", "kid_depth"])
            totals = totals.select("conv", "depth", *[(F.col(w) + F.col(f"k_{w}") + F.col(f"below.{w}")).alias(w) for w in sums])
            known = known.unionByName(materialise(totals, "totals"))
    return known.join(whole.select("conv", "depth", "kids"), ["conv", "depth"])


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per node: ``conv_id`` (the smallest member), ``depth``, ``parent_conv_id``,
    ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``, ``ends_sha256``.

    ``convs`` has ``conv, length``; ``turns`` has ``conv, length, place, h1, h2, words`` with
    places from 0 on without gaps (see ``rebuilt_turns``).  Conversations without turns are
    members of the root; without conversations there is no root and no row.  Turns are equal
    when both digests are.  A node of many conversations is summed before rows move; ids of
    those that end at it pass one task as a stream of strings, as its digest requires.
    """
    rows = materialise(_running(turns), "prefixes")
    found = rows.groupBy(*_KEY).agg(
        F.count(F.lit(1)).alias("n_convs"),
        F.min("conv").alias("conv"),
        *[F.min(c).alias(c) for c in ("words", "p1", "p2")],
    )
    all_convs = convs.agg(F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv")).filter("n_convs > 0")
    zero = F.lit(0).cast("bigint")
    root = all_convs.select(*[zero.alias(c) for c in (*_KEY, "words", "p1", "p2")], "n_convs", "conv")
    nodes = materialise(found.unionByName(root), "nodes")
    ups = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("up_conv")
    )
    above = (F.col("depth") - 1).alias("up_depth")
    saved = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    nodes = nodes.filter("depth > 0").join(ups, ["depth", "p1", "p2"]).select(*_KEY, "conv", "n_convs", "up_conv", above, saved).unionByName(
        nodes.filter("depth = 0").select(
            *_KEY, "conv", "n_convs", F.lit(None).cast("bigint").alias("up_conv"), F.lit(None).cast("bigint").alias("up_depth"), saved
        )
    )
    nodes = materialise(nodes, "nodes")
    totals = subtree_totals(nodes.select("conv", "depth", "up_conv", "up_depth", "saved"), ["saved"])
    last = rows.filter("depth = length").select(*_KEY, "conv")
    turnless = convs.filter("length = 0").select(*[zero.alias(c) for c in _KEY], "conv")
    ends = _ends(last.unionByName(turnless))
    return (
        nodes.drop("saved")
        .join(totals, ["conv", "depth"])
        .join(ends, _KEY, "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("up_conv").alias("parent_conv_id"),
            "n_convs",
            F.col("kids").alias("n_children"),
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """Trie of conversations that were given the first turns of their family.

    Columns besides those named are not looked at.  Repeated rows are turns of their own.
    """
    return prefix_trie(*rebuilt_turns(numbered_turns(conversations, **columns)))
