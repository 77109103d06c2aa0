"""The registered queries of the operators, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindle.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.secret_scan import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.sharding import shard_documents

    return shard_documents(table(spark, sf_dir, "documents"), shards=8)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.bpe import encode_digests

    return encode_digests(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.token_files import read_token_files, write_token_files

    return read_token_files(spark, write_token_files(table(spark, sf_dir, "documents")))


def op7_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.token_rollup import corpus_rollup

    return corpus_rollup(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.embed_dedup import near_vectors

    return near_vectors(table(spark, sf_dir, "embeddings"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.mixing import mix_plan

    return mix_plan(table(spark, sf_dir, "documents")).drop("copies")


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.fingerprint import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.merkle import verified_manifest

    return verified_manifest(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.prefix_trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from spindle.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OPERATORS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan, op2_sharding, op3_bpe, op4_toxicity, op5_minhash_dedup, op6_token_files, op7_token_rollup,
        op8_embedding_dedup, op9_mixing, op10_fingerprints, op11_merkle_manifest, op12_prefix_trie,
        op13_quality,
    )
}


def op8_sql() -> str:
    """All pairs by brute force, components by transitive closure over the links."""
    return """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
    SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v
    WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
), reach(u, v) AS (
    SELECT vec_id, vec_id FROM v UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.u = v.vec_id) AS n_links, m.c AS component_id, v.vec_id = m.c AS kept
FROM v JOIN (SELECT u, min(v) AS c FROM reach GROUP BY u) m ON m.u = v.vec_id"""


def op9_sql() -> str:
    """The same rule over whole sources by window functions."""
    return r"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5(coalesce(text, '')) AS th, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
    FROM documents
), s0 AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), s1 AS (
    SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE
              WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w FROM s0
), s2 AS (
    SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - 2.0::DOUBLE * coalesce(sum(source_size) OVER (
               ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
              / sum(w) OVER (ORDER BY 2.0::DOUBLE * source_size / w, source NULLS LAST
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM s1
), s3 AS (
    SELECT source, source_size, least(2.0::DOUBLE * source_size, coalesce(max(v) OVER (), 0) * w) AS target FROM s2
), s4 AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS e,
           ('0x' || substr(md5('mix' || coalesce(source, chr(0))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM s3
), r AS (
    SELECT d.*, row_number() OVER (PARTITION BY source ORDER BY size, h, doc_id NULLS FIRST, th) AS k FROM d
)
SELECT r.doc_id, r.size, s4.source_size, s4.target,
       ((floor(e) + floor(k * (e - floor(e)) + u) - floor((k - 1) * (e - floor(e)) + u))::BIGINT * r.size)::BIGINT AS taken
FROM r JOIN s4 ON r.source IS NOT DISTINCT FROM s4.source"""


def crc32_sql(text: str) -> str:
    """Unsigned crc32 of an ASCII text, bit by bit."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    byte = f"list_reduce(list_prepend(xor(a, b), range(8)), lambda c, bit: {step})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda a, b: {byte}), 4294967295::BIGINT)"


def op11_sql() -> str:
    """Levels from leaves to root, then every leaf's path up, one level a step."""

    def leaf(n_chars: str) -> str:
        fields = ("doc_id", "source", "lang", n_chars, "text")
        return "sha256(" + " || ".join(f"coalesce(strlen(({f})::VARCHAR) || ':' || ({f})::VARCHAR, '-')" for f in fields) + ")"

    return f"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce('1' || lang, '0') AS g, {leaf("n_chars")} AS leaf,
           CASE WHEN {crc32_sql("doc_id::VARCHAR")} % 7 = 0 AND n_chars IS NOT NULL THEN {leaf("n_chars + 1")} END AS changed
    FROM documents
), leaves AS (
    SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM d
), up(g, k, i, n, h) AS (
    SELECT g, 0, i, n, leaf FROM leaves
    UNION ALL SELECT g, k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM up WHERE n > 1 GROUP BY g, k, i // 2, n
), sub AS (
    SELECT g, k AS height, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM up WHERE n = 1
), top(k, i, n, h) AS (
    SELECT 0, i, n, subroot FROM sub
    UNION ALL SELECT k + 1, i // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY k, i // 2, n
), nodes AS (
    SELECT g, k, i, n, h FROM up UNION ALL SELECT '', k, i, n, h FROM top
), fold(g, tree, p, k, i, n, h, proof) AS (
    SELECT g, g, i, 0, i, n, coalesce(changed, leaf), '' FROM leaves
    UNION ALL
    SELECT f.g, CASE WHEN f.n = 1 THEN '' ELSE f.tree END, f.p, CASE WHEN f.n = 1 THEN 0 ELSE f.k + 1 END,
           CASE WHEN f.n = 1 THEN s.i ELSE f.i // 2 END, CASE WHEN f.n = 1 THEN s.n ELSE (f.n + 1) // 2 END,
           CASE WHEN f.n = 1 THEN f.h WHEN f.i % 2 = 1 THEN sha256(x.h || f.h) ELSE sha256(f.h || coalesce(x.h, '')) END,
           CASE WHEN f.n = 1 THEN f.proof ELSE f.proof || coalesce(x.h, '') END
    FROM fold f JOIN sub s ON s.g = f.g
    LEFT JOIN nodes x ON x.g = f.tree AND x.k = f.k AND x.i = xor(f.i, 1) AND f.n > 1
    WHERE f.n > 1 OR f.tree <> ''
)
SELECT l.doc_id, l.leaf, sub.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified
FROM leaves l JOIN sub ON sub.g = l.g JOIN fold f ON f.g = l.g AND f.p = l.i AND f.tree = '' AND f.n = 1
JOIN top r ON r.n = 1"""


def op12_sql() -> str:
    """Every conversation's prefixes as joined turn digests; subtrees from pairs of prefixes of one conversation."""
    return f"""
WITH raw AS (
    SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
), t AS (
    SELECT conv_id, md5(strlen(r) || ':' || r || x) AS id, length(x) AS chars,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(strlen(r) || ':' || r || x)) AS p FROM raw
), c AS (
    SELECT conv_id, {crc32_sql("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)
), parts AS (
    SELECT c.conv_id, 0 AS part, p, id, chars FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 WHERE p <= h
    UNION ALL SELECT c.conv_id, 1, p, id, chars FROM c JOIN t ON t.conv_id = c.conv_id WHERE p > h
), steps AS (
    SELECT conv_id, row_number() OVER w AS d, string_agg(id, '') OVER w AS k, chars,
           count(*) OVER (PARTITION BY conv_id) AS size
    FROM parts WINDOW w AS (PARTITION BY conv_id ORDER BY part, p ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), pre AS (
    SELECT conv_id, d, k, chars, d = size AS ends FROM steps
    UNION ALL SELECT conv_id, 0, '', 0, NOT EXISTS (SELECT 1 FROM parts WHERE parts.conv_id = c.conv_id) FROM c
), nodes AS (
    SELECT k, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * any_value(chars) AS saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends FROM pre GROUP BY k
), links AS (
    SELECT DISTINCT a.k AS top, b.k AS sub, b.d - a.d AS step FROM pre a JOIN pre b ON a.conv_id = b.conv_id AND a.d <= b.d
), childless AS (
    SELECT k FROM nodes WHERE k NOT IN (SELECT top FROM links WHERE step = 1)
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n AS n_convs, count(*) FILTER (WHERE l.step = 1) AS n_children,
       count(z.k) AS n_leaves, sum(s.saved)::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN links l ON l.top = n.k JOIN nodes s ON s.k = l.sub LEFT JOIN childless z ON z.k = l.sub
LEFT JOIN links u ON u.sub = n.k AND u.step = 1 LEFT JOIN nodes up ON up.k = u.top
GROUP BY n.k, n.conv_id, n.depth, up.conv_id, n.n, n.ends"""


def sql() -> dict[str, str]:
    return {"op8_embedding_dedup": op8_sql(), "op9_mixing": op9_sql(), "op11_merkle_manifest": op11_sql(), "op12_prefix_trie": op12_sql()}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return OPERATORS | {"pipeline": corpus_pipeline.run}
