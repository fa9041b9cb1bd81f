"""The operators as registered queries, with SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from coffer.llm import (
    embeddings,
    infill,
    jaccard,
    language,
    lines,
    mixing,
    packing,
    pieces,
    quality,
    rules,
    sharding,
    toxicity,
    tries,
)
from coffer.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]

# The vocabulary of byte_bpe_50k.json as ranks; ids are the same (see the tests).
VOCABULARY = "byte_bpe_50k.tiktoken"
SPECIAL = {"<|endoftext|>": 50256}

PIECES = "piece_bpe_32k.model"


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN, SPECIAL)


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op9_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).drop("curve")


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every text and of what they decode to."""
    model = public_tokenizers.path(PIECES)
    ids = pieces.encode_documents(table(spark, sf_dir, "documents"), model)
    digest = F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256")
    digested = ids.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), digest, "ids")
    texts = pieces.decode_documents(digested, model)
    return texts.withColumn("decoded_sha256", _digest(F.col("text"))).drop("text")


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every output and of the text restored from it."""
    found = infill.infilled(table(spark, sf_dir, "documents"))
    back = infill.restored(F.col("form"), F.col("output"))
    digests = {"output_sha256": _digest(F.col("output")), "restored_sha256": _digest(back)}
    return found.withColumns(digests).drop("output")


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tries.conversation_trie(table(spark, sf_dir, "conversations"))


def _digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def queries() -> dict[str, Query]:
    found = (
        op1_language,
        op2_quality,
        op3_embeddings,
        op4_mixing,
        op5_packing,
        op6_lines,
        op7_toxicity,
        op8_jaccard,
        op9_rules,
        op10_sharding,
        op11_pieces,
        op12_infill,
        op13_trie,
    )
    return {f.__name__: f for f in found}


_WORD = r"[^\x20\x09-\x0D]+"

# The same draws, targets and order; the cut is found by a running sum.
_MIXING = rf"""
WITH docs AS (
  SELECT doc_id, source, CAST(doc_id AS VARCHAR) || ':' || md5(coalesce(text, '')) AS draw,
         coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::BIGINT AS size
  FROM documents),
sizes AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
weighed AS (
  SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight,
         source_size * 3.0::DOUBLE AS most
  FROM sizes),
levels AS (
  SELECT *, (sum(source_size) OVER ()::DOUBLE
             - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST
                                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size,
         least(most, weight * first_value(level) OVER (
           ORDER BY CASE WHEN level * weight <= most THEN 0 ELSE 1 END, most / weight
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS target
  FROM levels),
shares AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS often FROM targets),
parts AS (
  SELECT *, least(floor(often), 3)::BIGINT AS whole, greatest(often - least(floor(often), 3), 0) AS share
  FROM shares),
classes AS (
  SELECT source, list({{w: weight, n: words}} ORDER BY weight) AS c FROM (
    SELECT source, sqrt(pow(2.0::DOUBLE, length(bin(size)))) AS weight, sum(size)::DOUBLE AS words
    FROM docs WHERE size > 0 GROUP BY 1, 2) GROUP BY source),
factors AS (
  SELECT p.source, list_reduce(
      list_prepend({{low: 0::DOUBLE, high: share / (1 - share) / c[1].w}},
                   list_transform(range(60), lambda i: {{low: 0::DOUBLE, high: 0::DOUBLE}})),
      lambda s, i: CASE
        WHEN list_sum(list_transform(c, lambda k: k.n * ((s.low + s.high) / 2 * k.w)
                                                  / (1 + (s.low + s.high) / 2 * k.w))) < share * source_size
        THEN {{low: (s.low + s.high) / 2, high: s.high}} ELSE {{low: s.low, high: (s.low + s.high) / 2}} END).high AS factor
  FROM parts p JOIN classes k ON k.source IS NOT DISTINCT FROM p.source WHERE share > 0 AND whole < 3),
drawn AS (
  SELECT d.doc_id, d.draw, d.size, p.source, p.source_size, p.target, p.whole, p.share, f.factor,
         (('0x' || substr(md5('mix:' || d.draw), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u
  FROM docs d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
  LEFT JOIN factors f ON f.source IS NOT DISTINCT FROM p.source),
odds AS (
  SELECT *, CASE WHEN size > 0 THEN (u / (1 - u)) / (factor * sqrt(pow(2.0::DOUBLE, length(bin(size))))) END AS q
  FROM drawn),
ranked AS (
  SELECT *, q / (1 + q) AS rank, share * source_size AS want FROM odds),
ended AS (
  SELECT *, CASE WHEN rank IS NOT NULL THEN sum(size) OVER (
              PARTITION BY source ORDER BY rank NULLS LAST, draw ROWS UNBOUNDED PRECEDING) END AS reach
  FROM ranked),
gaps AS (
  SELECT *, coalesce(reach <= want, false) AS fits,
         want - coalesce(max(CASE WHEN reach <= want THEN reach END) OVER (PARTITION BY source), 0) AS gap
  FROM ended),
lasts AS (
  SELECT *, CASE WHEN rank IS NOT NULL AND NOT fits AND abs(size - gap) < gap THEN row_number() OVER (
              PARTITION BY source ORDER BY CASE WHEN rank IS NOT NULL AND NOT fits THEN abs(size - gap) END
              NULLS LAST, rank NULLS LAST, draw) END AS place
  FROM gaps)
SELECT doc_id, size, source_size, target,
       (size * (whole + CASE WHEN fits OR coalesce(place = 1, false) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM lasts
"""

_LINES = r"""
WITH split AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
full_lines AS (
  SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS j
  FROM split WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
windows AS (
  SELECT a.doc_id, a.j, a.line || chr(10) || b.line || chr(10) || c.line AS w
  FROM full_lines a JOIN full_lines b ON b.doc_id = a.doc_id AND b.j = a.j + 1
                    JOIN full_lines c ON c.doc_id = a.doc_id AND c.j = a.j + 2),
later AS (
  SELECT doc_id, j FROM (
    SELECT doc_id, j, row_number() OVER (PARTITION BY w ORDER BY doc_id, j) AS n FROM windows) WHERE n > 1),
gone AS (
  SELECT DISTINCT f.doc_id, f.pos FROM full_lines f
  JOIN (SELECT doc_id, j + k AS j FROM later, (VALUES (0), (1), (2)) t(k)) l ON l.doc_id = f.doc_id AND l.j = f.j),
kept AS (
  SELECT s.doc_id, string_agg(s.line, chr(10) ORDER BY s.pos) AS text
  FROM split s LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.pos = s.pos WHERE g.pos IS NULL GROUP BY s.doc_id)
SELECT d.doc_id,
       coalesce((SELECT count(*) FROM full_lines f WHERE f.doc_id = d.doc_id), 0)::BIGINT AS n_lines,
       coalesce((SELECT count(*) FROM gone g WHERE g.doc_id = d.doc_id), 0)::BIGINT AS n_removed,
       CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

_COMPONENTS = """
reach(node, seen) AS (
  SELECT a, a FROM edges
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.seen)
"""

_EMBEDDINGS = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
norms AS (SELECT vec_id, v, sqrt(list_dot_product(v, v)) AS n FROM vectors),
edges AS MATERIALIZED (
  SELECT x.vec_id AS a, y.vec_id AS b FROM norms x JOIN norms y
  ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v) WHERE list_dot_product(x.v, y.v) / (x.n * y.n) >= 0.9),
{_COMPONENTS},
parts AS (SELECT node, min(seen) AS part FROM reach GROUP BY node),
links AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT e.vec_id, coalesce(l.n, 0)::BIGINT AS n_links, coalesce(p.part, e.vec_id) AS component_id,
       coalesce(p.part, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN links l ON l.a = e.vec_id LEFT JOIN parts p ON p.node = e.vec_id
"""

_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w
  FROM documents WHERE text IS NOT NULL),
shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
edges AS MATERIALIZED (
  SELECT a, b FROM shared h JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * h.n >= 80 * (x.n + y.n - h.n)),
{_COMPONENTS},
parts AS (SELECT node, min(seen) AS part FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles, coalesce(p.part, d.doc_id) AS component_id
FROM documents d LEFT JOIN sizes s USING (doc_id) LEFT JOIN parts p ON p.node = d.doc_id
"""


_INFILL = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS d
  FROM documents),
drawn AS (
  SELECT doc_id, text, units, len(units)::BIGINT AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1,
         ('0x' || substr(d, 9, 8))::BIGINT AS h2, ('0x' || substr(d, 17, 8))::BIGINT AS h3,
         ('0x' || substr(d, 25, 8))::BIGINT AS h4
  FROM cut),
parts AS (
  SELECT doc_id, text, n,
         array_to_string(units[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
         array_to_string(units[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
         array_to_string(units[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:n], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


# The checksum of a conversation's number, bit by bit; SQL has no function for it.
_CRC32 = """
xor(list_reduce(
  list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT),
  lambda crc, byte: list_reduce(
    range(8), lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(crc, byte)),
  4294967295::BIGINT), 4294967295)
"""

_TRIE = rf"""
WITH convs AS (
  SELECT conv_id AS c, conv_id - conv_id % 20 AS base, {_CRC32} % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL)),
turns AS (
  SELECT conv_id AS c, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS turn,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
whole AS (SELECT c, list(turn ORDER BY i) AS turns FROM turns GROUP BY c),
rebuilt AS (
  SELECT v.c, list_concat(coalesce(b.turns, [])[1:v.h], w.turns[v.h + 1:]) AS path
  FROM convs v JOIN whole w ON w.c = v.c LEFT JOIN whole b ON b.c = v.base),
steps AS (
  SELECT c, path, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt),
member AS (SELECT c, depth, len(path) AS length, path[1:depth] AS node FROM steps),
nodes AS (
  SELECT node, depth, min(c) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(CASE WHEN length = depth THEN CAST(c AS VARCHAR) END, ',' ORDER BY c), '') AS ends,
         (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE
           len(regexp_extract_all(node[depth].t, '{_WORD}')) END AS saved
  FROM member GROUP BY node, depth),
kids AS (
  SELECT p.node, count(k.node) AS n FROM nodes p
  LEFT JOIN nodes k ON k.depth = p.depth + 1 AND k.node[1:p.depth] = p.node GROUP BY p.node),
above AS (SELECT node, unnest(range(0, depth + 1)) AS d FROM nodes),
totals AS (
  SELECT a.node[1:a.d] AS node, sum(n.saved) AS saved, count(*) FILTER (k.n = 0) AS leaves
  FROM above a JOIN nodes n ON n.node = a.node JOIN kids k ON k.node = a.node GROUP BY 1)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       k.n::BIGINT AS n_children, t.leaves::BIGINT AS n_leaves, t.saved::BIGINT AS saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN kids k ON k.node = n.node JOIN totals t ON t.node = n.node
LEFT JOIN nodes p ON n.depth > 0 AND p.depth = n.depth - 1 AND p.node = n.node[1:n.depth - 1]
"""


def oracle_sql() -> dict[str, str]:
    """Models, token ids and the curve's quantiles have no SQL; tests hold them to brute force."""
    return {
        "op3_embeddings": _EMBEDDINGS,
        "op4_mixing": _MIXING,
        "op6_lines": _LINES,
        "op8_jaccard": _JACCARD,
        "op12_infill": _INFILL,
        "op13_trie": _TRIE,
    }
