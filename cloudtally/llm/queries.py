"""The registered queries of the subpackage, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cloudtally.llm import bpe, merkle, mil, mixing, nearest, packing, pii, pu, simhash, turns, vectors, warc, winnow
from cloudtally.llm.common import scratch, table

Query = Callable[[SparkSession, str], DataFrame]

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_attention_mil_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mil.score(docs, mil.fit(docs, table(spark, sf_dir, "labels")))


def op2_subspace_pigeonhole_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, sf_dir, "embeddings"))


def op3_warc_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path).drop("problem")


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op5_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "packs")
    packing.write_packs(packing.pack(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN), path)
    return packing.digests(spark.read.parquet(path))


def op6_pii_boosted_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.spans(docs, pii.fit(docs))

    def count(number: int):
        return F.size(F.filter("base", lambda s: s["kind"] == number)).cast("long").alias(f"n_{pii.KINDS[number]}")
    return found.select("doc_id", *map(count, range(len(pii.KINDS))),
                        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        pii.listed(F.col("spans")).alias("spans"))


def op7_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_likeness(table(spark, sf_dir, "documents"))


def op8_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), VOCABULARY)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mix(table(spark, sf_dir, "documents")))


def op10_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pu.score(docs, pu.fit(docs, table(spark, sf_dir, "labels")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turns.repaired(table(spark, sf_dir, "conversations"))


def op12_block_matrix_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = merkle.leaves(table(spark, sf_dir, "documents"), tampered)
    return merkle.prove(merkle.build(leaves, scratch(spark, "merkle")))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_attention_mil_quality, op2_subspace_pigeonhole_join, op3_warc_segments, op4_simhash_near_dedup, op5_token_packing,
        op6_pii_boosted_candidates, op7_winnowing, op8_bpe_encode_decode, op9_mixing, op10_pu_toxicity,
        op11_conversation_repair, op12_block_matrix_neighbours, op13_merkle_manifest)}


# Base32 by five of a digest's 160 bits at a time.
_WARC = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
     d AS (SELECT page_id, octet_length(b) AS payload_bytes, b, sha1(b) AS hex FROM p),
     w AS (SELECT *, max(page_id) OVER (PARTITION BY b) AS last FROM d)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           (CAST('0x' || substr(hex || '0', 1 + CAST((5 * i) // 4 AS INT), 2) AS INT)
            >> (3 - (5 * i) % 4)) & 31) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM w
"""


_VECTORS = """
v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
      WHERE len(embedding) > 0 AND list_count(embedding) = len(embedding)
        AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
"""

_NEAR_VECTORS = f"""
WITH RECURSIVE {_VECTORS},
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v AS a JOIN v AS b ON a.vec_id <> b.vec_id
      WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS c FROM embeddings UNION SELECT l.y, r.c FROM r JOIN l ON r.x = l.x),
m AS (SELECT x, min(c) AS component_id FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings AS e JOIN m ON e.vec_id = m.x LEFT JOIN n ON e.vec_id = n.x
"""

# Squares are added in the order of the axes; list_distance adds them in an order of its own.
_NEIGHBOURS = f"""
WITH {_VECTORS},
d AS (SELECT q.vec_id AS query_id, v.vec_id, sqrt(list_reduce(list_transform(list_zip(q.e, v.e),
          lambda p: (p[1] - p[2]) * (p[1] - p[2])), lambda a, b: a + b)) AS score FROM v AS q JOIN v ON q.vec_id <> v.vec_id
      WHERE q.vec_id % 100 = 0 AND len(q.e) = len(v.e)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INT) AS rank FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text as a DuckDB expression, bit by bit."""
    octets = f"list_transform(string_split({text}, ''), lambda ch: CAST(ord(ch) AS BIGINT))"
    bits = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    step = f"list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, y: {bits})"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {octets}), lambda c, b: {step}), 4294967295)"


def _merkle(levels: int = 8) -> str:
    """Trees of up to 16 ** `levels` leaves: the levels up, then each leaf's runs, its siblings and its folds."""
    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(map(field, (
            "CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text))) + ")"
    ctes = [f"""d AS (SELECT doc_id, coalesce('=' || source, '') AS s, {leaf('text')} AS leaf,
        CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 5 = 0
             THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS low FROM documents),
    a0 AS (SELECT *, leaf AS h, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM d)"""]

    def tree(t: str, key: str) -> None:
        for k in range(levels):
            ctes.append(f"""{t}r{k} AS (SELECT {key}, i // 16 AS i, list(h ORDER BY i) AS hs,
                sum(count(*)) OVER (PARTITION BY {key}) = 1 AS alone FROM {t}{k} GROUP BY {key}, i // 16)""")
            ctes.append(f"""{t}{k + 1} AS (SELECT {key}, i, CASE WHEN alone THEN hs[1] ELSE sha256(array_to_string(hs, '')) END AS h
                FROM {t}r{k})""")
    tree("a", "s")
    ctes.append("b0 AS (SELECT 0 AS z, s, h, row_number() OVER (ORDER BY s) - 1 AS i FROM a8)".replace("a8", f"a{levels}"))
    tree("b", "z")
    now = "(SELECT a0.s, a0.doc_id, a0.leaf, a0.i, b0.i AS j, coalesce(a0.low, a0.leaf) AS f, '' AS p, 0 AS z FROM a0 JOIN b0 ON a0.s = b0.s)"
    for t, key, at in (("a", "s", "i"), ("b", "z", "j")):
        for k in range(levels):
            name = f"{t}f{k}"
            place = f"CAST((n.{at} // {16 ** k}) % 16 AS INT)"
            ctes.append(f"""{name} AS (SELECT n.* REPLACE (
                CASE WHEN r.alone THEN n.f ELSE sha256(array_to_string(r.hs[1:{place}] || [n.f] || r.hs[{place} + 2:], '')) END AS f,
                CASE WHEN r.alone THEN n.p ELSE n.p || array_to_string(r.hs[1:{place}] || r.hs[{place} + 2:], '') END AS p)
                FROM {now} AS n JOIN {t}r{k} AS r ON n.{key} = r.{key} AND n.{at} // {16 ** (k + 1)} = r.i)""")
            now = name
    return f"""WITH {", ".join(ctes)}
SELECT n.doc_id, n.leaf, a{levels}.h AS subroot, b{levels}.h AS root, sha256(n.p) AS proof_sha256, n.f AS folded_root,
       n.f = b{levels}.h AS verified
FROM {now} AS n JOIN a{levels} ON n.s = a{levels}.s CROSS JOIN b{levels}"""


def _repair() -> str:
    """Row by row, the least cost and audit (nine digits and the edits, so that texts compare as pairs) in four states.

    x0 nothing kept, x1 after a system row, x2 after a user row, x3 after an assistant row.
    """
    def made(x: str, cost: str, edit: str) -> str:
        return f"(lpad(CAST(CAST(left({x}, 9) AS BIGINT) + {cost} AS VARCHAR), 9, '0') || substr({x}, 10) || '{edit}')"

    def kept(x: str, kind: str) -> str:
        both = made(x, "1 + l", "R") if kind != "s" else "NULL"
        return f"CASE WHEN NOT forced THEN least(CASE WHEN kind = '{kind}' THEN {made(x, 'l', 'K')} END, {both}) END"

    def gone(x: str) -> str:
        return made(x, "2", "D")
    turn = "coalesce(CAST(turn AS VARCHAR), ' ')"
    white = "\\x20\\x09-\\x0D"
    insert = f"""least(x2, {made('x0', '5', 'I')}, {made('x1', '5', 'I')}, {made('x3', '5', 'I')})"""
    return f"""
WITH RECURSIVE c AS (SELECT *, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || " + turn)} % 20 AS k FROM conversations),
d AS (SELECT coalesce('=' || conv_id, '') AS g, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
          CASE WHEN k = 1 THEN '' WHEN k = 2 THEN translate(coalesce(text, ' '), '.!?', '') ELSE coalesce(text, ' ') END AS text,
          unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM c WHERE k <> 0),
e AS (SELECT *, NOT regexp_matches(text, '[^{white}]') AS blank, row_number() OVER (
          PARTITION BY g ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
          row_number() OVER (PARTITION BY g, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again FROM d),
f AS (SELECT *, NOT blank AND again AS duplicate, NOT blank AND NOT again AND NOT regexp_matches(text, '[.!?][{white}]*$') AS short,
          blank OR again AS forced, left(role, 1) AS kind, lag(left(role, 1)) OVER (PARTITION BY g ORDER BY i) AS prior FROM e),
s AS (SELECT g, coalesce(CAST(max(turn) - min(turn) + 1 - count(DISTINCT turn) AS BIGINT), 0) AS gaps, count(*) FILTER (blank) AS blank,
          count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (short) AS truncated,
          count(*) FILTER (prior IS NOT NULL AND prior || kind NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY g),
p AS (SELECT g, CAST(0 AS BIGINT) AS i, '000000000' AS x0, CAST(NULL AS VARCHAR) AS x1, '000000005I' AS x2, '000000010II' AS x3 FROM s
      UNION ALL
      SELECT g, i, x0, x1, x2, least(x3, {made('x2', '5', 'I')}) FROM (
          SELECT g, i, x0, x1, {insert} AS x2, x3 FROM (
              SELECT p.g, q.i, {gone('x0')} AS x0, least({gone('x1')}, {kept('x0', 's')}) AS x1,
                     least({gone('x2')}, {kept('x0', 'u')}, {kept('x1', 'u')}, {kept('x3', 'u')}) AS x2,
                     least({gone('x3')}, {kept('x2', 'a')}) AS x3
              FROM p JOIN (SELECT *, CASE WHEN short THEN 5 ELSE 0 END AS l FROM f) AS q ON p.g = q.g AND p.i + 1 = q.i))),
b AS (SELECT g, arg_max(least(x0, x3), i) AS x FROM p GROUP BY g),
o AS (SELECT g, unnest(string_split(substr(x, 10), '')) AS edit, generate_subscripts(string_split(substr(x, 10), ''), 1) AS j FROM b),
w AS (SELECT *, sum(CASE WHEN edit <> 'I' THEN 1 ELSE 0 END) OVER v AS i, sum(CASE WHEN edit <> 'D' THEN 1 ELSE 0 END) OVER v AS n,
          count(*) FILTER (edit <> 'D') OVER (PARTITION BY g) AS m FROM o WINDOW v AS (PARTITION BY g ORDER BY j)),
h AS (SELECT w.g, sha256(string_agg(CASE WHEN edit = 'K' THEN f.role WHEN (n - m % 2) % 2 = 1 THEN 'user' ELSE 'assistant' END
          || ':' || CASE WHEN edit = 'I' THEN '' ELSE f.text END, chr(10) ORDER BY n)) AS hash
      FROM w JOIN f ON w.g = f.g AND f.i = greatest(w.i, 1) WHERE edit <> 'D' GROUP BY w.g)
SELECT a.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
       coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, CAST(coalesce(left(b.x, 9), '0') AS BIGINT) AS cost,
       coalesce(substr(b.x, 10), '') AS audit, coalesce(h.hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '') AS g FROM conversations) AS a
LEFT JOIN s ON a.g = s.g LEFT JOIN b ON a.g = b.g LEFT JOIN h ON a.g = h.g"""


def oracle_sql() -> dict[str, str]:
    return {"op2_subspace_pigeonhole_join": _NEAR_VECTORS, "op3_warc_segments": _WARC,
            "op11_conversation_repair": _repair(), "op12_block_matrix_neighbours": _NEIGHBOURS, "op13_merkle_manifest": _merkle()}
