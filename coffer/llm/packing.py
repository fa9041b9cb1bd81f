"""Packing of tokenised documents into sequences of bounded length and even cost.

The cost of a piece is estimated as a linear part plus a part that grows with its square,
as attention does within a document.  Documents are packed in pools: whole sequences are
cut off long documents, then what is left goes, longest first, to the sequence of least
cost among all that still have room for it.  A piece that fits nowhere is cut to fill the
room that is left, so all sequences of a pool but the last are full.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coffer.llm.frames import bounded_batches

LENGTH = 2048
END_ID = 1

# Estimated cost of a token, and of a pair of tokens of one piece.
LINEAR, QUADRATIC = 1.0, 1.0 / 1024

# Tokens that are packed together; a task holds one pool and one document at a time.
POOL_TOKENS = 1 << 20

# Rows handed to Python at once, so that a batch of long texts stays small.
BATCH_ROWS = 200

# The splitter runs out of stack on about a million white characters in a row.
SAFE_RUN = 100_000

# White space of Unicode, as the splitter knows it; Python's own class holds four more.
_WHITE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

_SEQUENCE_BITS = 36


def cost(length: int) -> float:
    return LINEAR * length + QUADRATIC * length * length


def pack(sizes: list[int], length: int = LENGTH) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)`` of documents of given sizes.

    Sequences are numbered from 0 and number as few as can hold all tokens.
    """
    pieces: list[tuple[int, int, int, int, int]] = []
    rest: list[tuple[int, int, int]] = []
    done = 0
    for doc, size in enumerate(sizes):
        full = size // length
        pieces += [(doc, k * length, length, done + k, 0) for k in range(full)]
        done += full
        if size > full * length:
            rest.append((size - full * length, doc, full * length))
    rest.sort(key=lambda r: (-r[0], r[1]))
    n = -(-sum(r[0] for r in rest) // length)
    # The last sequence takes what does not fill one; its end is the only room left over.
    room = np.full(n, length, dtype=np.int64)
    if n:
        room[-1] = sum(r[0] for r in rest) - (n - 1) * length
    used, spent = np.zeros(n, dtype=np.int64), np.zeros(n)

    def put(doc: int, start: int, size: int, i: int) -> None:
        pieces.append((doc, start, size, done + i, int(used[i])))
        used[i] += size
        room[i] -= size
        spent[i] += cost(size)

    for size, doc, start in rest:
        costs = np.where(room >= size, spent, np.inf)
        at = int(costs.argmin())
        if costs[at] < np.inf:
            put(doc, start, size, at)
            continue
        while size:
            # No room for the whole: fill sequences, the cheapest first.
            at = int(np.where(room > 0, spent, np.inf).argmin())
            part = min(size, int(room[at]))
            put(doc, start, part, at)
            start, size = start + part, size - part
    return pieces


def _encoder(path: str, pattern: str, special: dict[str, int]):
    """Function from a text to its ids, for a byte-level vocabulary of ranks.

    The strings of ``special`` are tokens of their own wherever a text holds them.
    ``pattern`` has to end in the rule for white space of byte-level vocabularies: a run
    before other text leaves its last character to what follows and is one piece else, at
    the end as before a special token.  Runs beyond ``SAFE_RUN`` are cut by it here.
    """
    import tiktoken

    if not pattern.endswith(r"|\s+(?!\S)|\s+"):
        raise ValueError("pattern with another rule for white space")

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    white = tiktoken.Encoding("white", pat_str=r"\s+", mergeable_ranks=ranks, special_tokens={})
    long_run = re.compile(rf"(?<!{_WHITE}){_WHITE}{{{SAFE_RUN + 1},}}")
    marks = tuple(special)

    def plain(text: str) -> list[int]:
        if any(m in text for m in marks):
            return own.encode(text, allowed_special="all")
        return own.encode_ordinary(text)

    def encode(text: str) -> list[int]:
        ids, at = [], 0
        if len(text) > SAFE_RUN:
            for run in long_run.finditer(text):
                followed = run.end() < len(text) and not text.startswith(marks, run.end())
                end = run.end() - followed
                ids += plain(text[at : run.start()])
                ids += white.encode_ordinary(text[run.start() : end])
                at = end
        return ids + plain(text[at:]) if at else plain(text)

    return encode


def _piece_batches(schema: pa.Schema, partition: int, length: int, end_id: int, encode, batches) -> Iterator:
    first = 0  # number of the next sequence of this partition
    ids, tokens, held = [], [], 0

    def packed():
        nonlocal first, ids, tokens, held
        found = pack([len(t) for t in tokens], length)
        columns = {f.name: [] for f in schema}
        for doc, start, size, sequence, offset in found:
            columns["id"].append(ids[doc])
            columns["start"].append(start)
            columns["length"].append(size)
            columns["ids_crc32"].append(zlib.crc32(tokens[doc][start : start + size].tobytes()))
            columns["doc_tokens"].append(len(tokens[doc]))
            columns["sequence_id"].append((partition << _SEQUENCE_BITS) + first + sequence)
            columns["offset"].append(offset)
        first += 1 + max((f[3] for f in found), default=-1)
        ids, tokens, held = [], [], 0
        return pa.RecordBatch.from_pydict(columns, schema)

    for batch in batches:
        names, texts = batch.column("id").to_pylist(), batch.column("text")
        for name, text in zip(names, texts):
            own = encode(text.as_py() or "")
            own.append(end_id)
            tokens.append(np.array(own, dtype="<u4"))
            ids.append(name)
            held += len(own)
            if held >= POOL_TOKENS:
                yield packed()
    if tokens:
        yield packed()


def pack_documents(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    special: dict[str, int],
    length: int = LENGTH,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``.

    ``vocabulary`` is the file of ranks, readable on every worker, ``pattern`` what splits a
    text before merges, and ``special`` has the ids of strings that are tokens in themselves.  Every document ends with ``end_id``, so a NULL
    or empty text is one token.  Every row in is a document of its own, repeated rows and
    NULL ids included.  Token ids never leave the task that made them: pools are filled from the rows of a
    partition in their order, and a partition that runs again gives the same pieces.  Each
    partition leaves one sequence that is not full.
    """
    bounded_batches(docs.sparkSession, BATCH_ROWS)
    kind = docs.schema[id_col].dataType.simpleString()

    def pieces(batches):
        from pyspark import TaskContext

        head = next(batches, None)
        if head is None:
            return
        numbers = ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
        schema = pa.schema([pa.field("id", head.schema.field("id").type)] + [pa.field(n, pa.int64()) for n in numbers])
        encode = _encoder(vocabulary, pattern, special)
        yield from _piece_batches(
            schema, TaskContext.get().partitionId(), length, end_id, encode, chain([head], batches)
        )

    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        pieces,
        f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
    return found.withColumnRenamed("id", id_col)
