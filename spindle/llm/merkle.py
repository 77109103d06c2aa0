"""A Merkle manifest of a table: one leaf per row, a binary tree per language, a tree of the languages' roots.

``H`` is the lower-case hex SHA-256 of its inputs' concatenation, digests taken as hex text.  A level of a tree is a row
of digests of fixed width, so an *aligned block* of ``BLOCK`` neighbouring nodes keeps each of its levels as one hex
string: a parent is the hash of a substring of two digests (one at the end of the tree), and the siblings of a node are
the substrings that flank it within its run.  A block is left with one digest; these are the nodes of the next
round, cut into blocks again, until each tree has one.  Positions are exact and gapless: rows are range-partitioned by
``(group, order)``, numbered within their partition, and shifted by the counts of the partitions before.  A language that
holds most rows is many blocks and so many tasks; no task ever holds more than a block of one tree at a time.

Proofs are handed down: a block joins its own flanks to the path of its root, so only blocks are joined, never rows.

Edge cases: a null column enters its leaf as ``-``, an empty text as ``0:``; leaves stand by doc_id, null first, equal
ones by their digest, so repeated rows are leaves of their own with one digest; a null language is a tree of its
own, the first; a null doc_id or n_chars is never tampered with; a single leaf is its language's subroot and, with no
other language, the root, with an empty proof; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spindle.llm.common import pick, stored

DIGEST = 64  # hex characters
ROUND = 8  # levels of a block
BLOCK = 1 << ROUND
TAMPER = 7  # rows whose crc32(doc_id as text) it divides are tampered with in the manifest's self-test
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(**changed: Column) -> Column:
    """H of the row's fields, each with its UTF-8 length before it, so that no two rows read alike."""

    def field(name: str) -> Column:
        value = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[field(n) for n in FIELDS]).cast("binary"), 256)


def placed(rows: DataFrame, order: list[str], tag: str) -> DataFrame:
    """``rows`` with ``pos``, the place from 0 by ``order`` within their group ``g``, and ``n``, the group's size.

    ``order`` must set apart all but equal rows.  The ids that break ties among those let them spread over partitions.
    """
    keys = ["g", *order, "uid"]
    given = rows.columns
    ranged = stored(rows.withColumn("uid", F.monotonically_increasing_id()), f"merkle-{tag}-rows")
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = ranged.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
    # The id of a row is its partition and its place there: partitions and places both ascend with the keys.
    ranged = stored(ranged.select(*given, F.monotonically_increasing_id().alias("at")), f"merkle-{tag}-sorted")
    part = F.shiftright("at", 33)
    counts = ranged.groupBy("g", part.alias("part")).agg(F.count(F.lit(1)).alias("c"), F.min("at").alias("low"))
    # A group has at most one count per partition.
    whole = Window.partitionBy("g")
    upto = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.select("g", "part", "low", (F.sum("c").over(upto) - F.col("c")).alias("before"), F.sum("c").over(whole).alias("n"))
    found = ranged.withColumn("part", part).join(counts, ["g", "part"])
    return found.select(*given, (F.col("before") + F.col("at") - F.col("low")).alias("pos"), "n")


def blocks(nodes: DataFrame, extra: list[str], tag: str) -> DataFrame:
    """``g, block, n, levels, l0.., top, members`` from ``g, pos, n, digest`` and the columns ``extra`` of a member.

    ``l<k>`` is level k of the block as one hex string (binary, so that a substring is a cut, not a scan), ``levels`` how
    many steps lead to ``top``, the one digest left: ``ROUND``, or fewer where the tree ends within the block.
    """
    member = F.struct("pos", "digest", *extra)
    got = nodes.groupBy("g", F.shiftright("pos", ROUND).alias("block"), "n").agg(F.sort_array(F.collect_list(member)).alias("members"))
    depth = F.when(F.col("n") > BLOCK, ROUND).otherwise(F.length(F.conv((F.col("n") - 1).cast("string"), 10, 2)))
    got = got.withColumn("levels", F.when(F.col("n") == 1, 0).otherwise(depth).cast("int"))
    got = got.withColumn("l0", F.expr("CAST(array_join(transform(members, m -> m.digest), '') AS BINARY)"))
    for k in range(ROUND):
        parents = f"""transform(sequence(0, cast((octet_length(l{k}) - 1) div {2 * DIGEST} as int)),
            i -> sha2(substring(l{k}, 1 + i * {2 * DIGEST}, {2 * DIGEST}), 256))"""
        got = got.withColumn(f"l{k + 1}", F.expr(f"IF(levels > {k}, CAST(array_join({parents}, '') AS BINARY), l{k})"))
    got = got.withColumn("top", F.col(f"l{ROUND}").cast("string")).drop(f"l{ROUND}")
    return stored(got, f"merkle-{tag}-blocks")


def flanks(i: str) -> str:
    """SQL: what stands left and right of member ``i``'s path in the runs of its block, level by level."""

    def cut(k: int) -> str:
        at = f"cast(shiftright({i}, {k}) as int)"
        left = f"CAST(substring(l{k}, 1 + {DIGEST} * ({at} - 1), {DIGEST} * ({at} % 2)) AS STRING)"
        right = f"CAST(substring(l{k}, 1 + {DIGEST} * ({at} + 1), {DIGEST} * (1 - {at} % 2)) AS STRING)"
        return f"named_struct('l', IF({at} % 2 = 1, {left}, ''), 'r', {right})"

    return f"slice(array({', '.join(cut(k) for k in range(ROUND))}), 1, levels)"


NO_PATH = "CAST(array() AS ARRAY<STRUCT<l: STRING, r: STRING>>)"


def tree(nodes: DataFrame, extra: list[str], tag: str) -> tuple[list[DataFrame], DataFrame]:
    """The rounds of blocks over ``g, pos, n, digest``, and ``g, top`` of every group."""
    rounds, tops = [], None
    while True:
        found = blocks(nodes, [] if rounds else extra, f"{tag}-{len(rounds)}")
        rounds.append(found)
        done = found.where(f"n <= {BLOCK}").select("g", "top")
        tops = done if tops is None else tops.unionByName(done)
        rest = found.where(f"n > {BLOCK}")
        if rest.isEmpty():
            return rounds, tops
        nodes = rest.select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / BLOCK).cast("bigint").alias("n"), F.col("top").alias("digest"))


def with_path(rounds: list[DataFrame], tag: str) -> DataFrame:
    """The blocks of the first round with ``up``: the flanks from a block's top to its tree's, found from the top down."""
    found = rounds[-1].withColumn("up", F.expr(NO_PATH))
    for k in range(len(rounds) - 1, 0, -1):
        own = f"inline(transform(members, (m, i) -> named_struct('block', m.pos, 'up', concat({flanks('i')}, up))))"
        path = stored(found.select("g", F.expr(own)), f"merkle-{tag}-path{k}")
        # A tree that is done after this round has no node in the next.
        found = rounds[k - 1].join(path, ["g", "block"], "left").withColumn("up", F.expr(f"coalesce(up, {NO_PATH})"))
    return found


def manifest(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """``doc_id, lang, pos, leaf, subroot, root, path, folded_root`` for every row.

    ``path`` lists the siblings from leaf to root as ``(l, r)``: what stands left and right of the node in its run.
    ``folded_root`` is the root recomputed by that path from the leaf, or from the leaf of a row whose n_chars
    was raised by one where ``tamper`` holds.
    """
    rows = pick(docs, *FIELDS)
    changed = F.lit(None).cast("string") if tamper is None else F.when(tamper & F.col("n_chars").isNotNull(), leaf_digest(n_chars=F.col("n_chars") + 1))
    # '0' for the null language and '1' before any other keep the order of bytes, null first
    rows = rows.select(
        F.coalesce(F.concat(F.lit("1"), "lang"), F.lit("0")).alias("g"), "doc_id", leaf_digest().alias("digest"), changed.alias("changed")
    )
    leaves = placed(rows, ["doc_id", "digest"], "leaf")
    rounds, subroots = tree(leaves, ["doc_id", "changed"], "leaf")
    subroots = stored(subroots.select(F.lit("").alias("g"), F.col("g").alias("lang"), F.col("top").alias("digest")), "merkle-subroots")
    langs = placed(subroots, ["lang", "digest"], "lang")
    lang_rounds, root = tree(langs, ["lang"], "lang")
    whole = root.select("g", F.col("top").alias("root"))
    own = F.expr(f"inline(transform(members, (m, i) -> named_struct('lang', m.lang, 'subroot', m.digest, 'rest', concat({flanks('i')}, up))))")
    upper = with_path(lang_rounds, "lang").join(whole, "g").select("root", own)
    upper = stored(upper.select(F.col("lang").alias("g"), "subroot", "root", "rest"), "merkle-upper")

    lower = with_path(rounds, "leaf").join(upper, "g").withColumn("up", F.concat("up", "rest"))
    member = F.expr(f"""inline(transform(members, (m, i) -> named_struct('doc_id', m.doc_id, 'pos', m.pos, 'leaf', m.digest,
        'start', coalesce(m.changed, m.digest), 'path', concat({flanks("i")}, up))))""")
    fold = "aggregate(path, start, (h, f) -> sha2(CAST(concat(f.l, h, f.r) AS BINARY), 256))"
    lang = F.expr("IF(g = '0', NULL, substring(g, 2))")
    return lower.select(lang.alias("lang"), "subroot", "root", member).select(
        "doc_id", "lang", "pos", "leaf", "subroot", "root", "path", F.expr(fold).alias("folded_root")
    )


def verified_manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``: the manifest with its self-test.

    Rows whose crc32(doc_id as text) ``TAMPER`` divides are folded from a tampered leaf and must not verify.
    """
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER == 0, F.lit(False))
    found = manifest(docs, tampered)
    proof = F.expr("sha2(CAST(array_join(transform(path, f -> concat(f.l, f.r)), '') AS BINARY), 256)")
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified")
    )
