"""DuckDB SQL text that recomputes each registered query independently (the correctness oracle).

The clustering oracles work in long form ``(rid, grp, j, x)`` and unroll every Lloyd / Fair-Lloyd round and every
step of the balance search into CTEs, computing the group means and scatters by a second scan, the direct way.
They share nothing with the Spark code except the rules being checked.
"""

from __future__ import annotations

from spindle.functions.hashing import HashFamily

R = 6  # decimals kept when comparing doubles

# ---------------------------------------------------------------------------------------------------------------
# Point sets
# ---------------------------------------------------------------------------------------------------------------

POINTS = {
    "embeddings": (
        "SELECT vec_id AS id, CASE WHEN label % 4 = 0 THEN 'B' ELSE 'A' END AS grp, "
        "CAST(embedding AS DOUBLE[]) AS f FROM embeddings"
    ),
    "lineitem": (
        "SELECT l_orderkey * 10 + l_linenumber AS id, CASE WHEN l_returnflag = 'R' THEN 'B' ELSE 'A' END AS grp, "
        "[l_quantity, l_discount * CAST(100.0 AS DOUBLE)] AS f FROM lineitem"
    ),
}


def _base(dataset: str, k: int) -> list[str]:
    """CTEs: pts (rid, id, grp, f), lf (long form), c0 (first k points by (id, f) as centres)."""
    return [
        f"pts AS MATERIALIZED (SELECT row_number() OVER () AS rid, id, grp, f FROM ({POINTS[dataset]}) s)",
        "lf AS MATERIALIZED (SELECT rid, grp, unnest(range(len(f))) AS j, unnest(f) AS x FROM pts)",
        "c0 AS MATERIALIZED (SELECT k.ci, lf.j, lf.x AS c FROM (SELECT rid, CAST(row_number() OVER (ORDER BY id, f) - 1 "
        f"AS INTEGER) AS ci FROM pts ORDER BY id, f LIMIT {k}) k JOIN lf USING (rid))",
    ]


def _assign(name: str, centers: str) -> str:
    d2 = "sum((lf.x - c.c) * (lf.x - c.c))"
    return (
        f"{name} AS MATERIALIZED (SELECT rid, grp, ci, d2 FROM (SELECT lf.rid, lf.grp, c.ci, {d2} AS d2, "
        f"row_number() OVER (PARTITION BY lf.rid ORDER BY {d2}, c.ci) AS rn FROM lf JOIN {centers} c USING (j) "
        "GROUP BY lf.rid, lf.grp, c.ci) t WHERE rn = 1)"
    )


def _lloyd_round(p: str, m: int) -> list[str]:
    a, cur, nxt = f"{p}a{m}", f"{p}c{m}", f"{p}c{m + 1}"
    return [
        _assign(a, cur),
        f"{p}m{m} AS (SELECT a.ci, lf.j, avg(lf.x) AS c FROM {a} a JOIN lf USING (rid) GROUP BY a.ci, lf.j)",
        f"{nxt} AS MATERIALIZED (SELECT c.ci, c.j, coalesce(m.c, c.c) AS c FROM {cur} c "
        f"LEFT JOIN {p}m{m} m USING (ci, j))",
    ]


def _fair_stats(p: str, m: int) -> list[str]:
    """CTEs for one round's statistics: assignment, per (ci, j) means, per ci (n_a, n_b, alpha, beta, ell), scatter."""
    a, cur = f"{p}a{m}", f"{p}c{m}"
    return [
        _assign(a, cur),
        f"{p}g{m} AS MATERIALIZED (SELECT a.ci, a.grp, lf.j, avg(lf.x) AS mu, count(*) AS n FROM {a} a "
        "JOIN lf USING (rid) GROUP BY a.ci, a.grp, lf.j)",
        f"{p}sz{m} AS MATERIALIZED (SELECT count(*) FILTER (WHERE grp = 'A') AS size_a, "
        f"count(*) FILTER (WHERE grp = 'B') AS size_b FROM {a})",
        f"{p}cl{m} AS MATERIALIZED (SELECT ci, j, coalesce(ma, mb) AS mu_a, coalesce(mb, ma) AS mu_b, n_a, n_b FROM "
        "(SELECT ci, j, max(mu) FILTER (WHERE grp = 'A') AS ma, max(mu) FILTER (WHERE grp = 'B') AS mb, "
        "coalesce(max(n) FILTER (WHERE grp = 'A'), 0) AS n_a, coalesce(max(n) FILTER (WHERE grp = 'B'), 0) AS n_b "
        f"FROM {p}g{m} GROUP BY ci, j) t)",
        f"{p}k{m} AS MATERIALIZED (SELECT k.ci, k.n_a, k.n_b, k.ell, "
        "CASE WHEN s.size_a > 0 THEN CAST(k.n_a AS DOUBLE) / s.size_a ELSE 0.0 END AS alpha, "
        "CASE WHEN s.size_b > 0 THEN CAST(k.n_b AS DOUBLE) / s.size_b ELSE 0.0 END AS beta FROM "
        "(SELECT ci, any_value(n_a) AS n_a, any_value(n_b) AS n_b, CASE WHEN bool_and(mu_a = mu_b) THEN 0.0 "
        f"ELSE sqrt(sum((mu_a - mu_b) * (mu_a - mu_b))) END AS ell FROM {p}cl{m} GROUP BY ci) k, {p}sz{m} s)",
        f"{p}fx{m} AS MATERIALIZED (SELECT "
        "CASE WHEN any_value(s.size_a) > 0 THEN coalesce(sum((lf.x - cl.mu_a) * (lf.x - cl.mu_a)) "
        "FILTER (WHERE a.grp = 'A'), 0) / any_value(s.size_a) ELSE 0.0 END AS fixed_a, "
        "CASE WHEN any_value(s.size_b) > 0 THEN coalesce(sum((lf.x - cl.mu_b) * (lf.x - cl.mu_b)) "
        "FILTER (WHERE a.grp = 'B'), 0) / any_value(s.size_b) ELSE 0.0 END AS fixed_b "
        f"FROM {a} a JOIN lf USING (rid) JOIN {p}cl{m} cl ON cl.ci = a.ci AND cl.j = lf.j, {p}sz{m} s)",
    ]


def _balance(p: str, m: int) -> list[str]:
    """The 10-step gamma bisection; ``{p}x{m}_10`` holds the final (ci, alpha, beta, ell, x)."""
    out = [f"{p}b{m}_1 AS (SELECT CAST(0.5 AS DOUBLE) AS g, false AS stop)"]
    for t in range(1, 11):
        den = "(b.g * k.alpha + (1 - b.g) * k.beta)"
        out.append(
            f"{p}x{m}_{t} AS (SELECT k.ci, k.alpha, k.beta, k.ell, b.g, b.stop, "
            f"CASE WHEN {den} = 0 THEN 0.0 ELSE (1 - b.g) * k.beta * k.ell / {den} END AS x "
            f"FROM {p}k{m} k, {p}b{m}_{t} b)"
        )
        if t == 10:
            break
        step = 0.5 ** (t + 1)
        out.append(
            f"{p}e{m}_{t} AS (SELECT any_value(g) AS g, any_value(stop) AS stop, "
            f"(SELECT fixed_a FROM {p}fx{m}) + sum(alpha * x * x) AS fa, "
            f"(SELECT fixed_b FROM {p}fx{m}) + sum(beta * (ell - x) * (ell - x)) AS fb FROM {p}x{m}_{t})"
        )
        out.append(
            f"{p}b{m}_{t + 1} AS (SELECT CASE WHEN stop OR fa = fb THEN g WHEN fa > fb THEN g + {step!r} "
            f"ELSE g - {step!r} END AS g, stop OR fa = fb AS stop FROM {p}e{m}_{t})"
        )
    return out


def _fair_round(p: str, m: int) -> list[str]:
    cur, nxt = f"{p}c{m}", f"{p}c{m + 1}"
    return (
        _fair_stats(p, m)
        + _balance(p, m)
        + [
            f"{nxt} AS MATERIALIZED (SELECT c.ci, c.j, CASE WHEN cl.ci IS NULL THEN c.c WHEN x.ell = 0 THEN cl.mu_a "
            "ELSE ((x.ell - x.x) * cl.mu_a + x.x * cl.mu_b) / x.ell END AS c "
            f"FROM {cur} c LEFT JOIN {p}cl{m} cl USING (ci, j) LEFT JOIN {p}x{m}_10 x USING (ci))"
        ]
    )


def _chain(kind: str, p: str, rounds: int) -> tuple[list[str], str]:
    """CTEs running ``rounds`` rounds of ``kind`` from c0; returns (ctes, name of the final centres)."""
    ctes = [f"{p}c0 AS (SELECT * FROM c0)"]
    for m in range(rounds):
        ctes += _lloyd_round(p, m) if kind == "lloyd" else _fair_round(p, m)
    return ctes, f"{p}c{rounds}"


def _objectives(name: str, assigned: str) -> str:
    return (
        f"{name} AS (SELECT count(*) AS n, count(*) FILTER (WHERE grp = 'A') AS n_a, "
        "count(*) FILTER (WHERE grp <> 'A') AS n_b, sum(d2) AS s, sum(d2) FILTER (WHERE grp = 'A') AS s_a, "
        f"sum(d2) FILTER (WHERE grp = 'B') AS s_b FROM {assigned})"
    )


def _phi(o: str) -> str:
    return (
        f"CASE WHEN {o}.n_a = 0 OR {o}.n_b = 0 THEN 0.0 ELSE greatest({o}.s_a / {o}.n_a, {o}.s_b / {o}.n_b) END"
    )


def _with(ctes: list[str], body: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + body


def _long_centers(name: str) -> str:
    return f"SELECT CAST(ci AS INTEGER) AS ci, CAST(j AS INTEGER) AS j, round(c, {R}) AS value FROM {name}"


# ---------------------------------------------------------------------------------------------------------------
# Clustering queries
# ---------------------------------------------------------------------------------------------------------------


def points_from_table(dataset: str) -> str:
    return (
        f"SELECT id, grp, CAST(len(f) AS INTEGER) AS dim, round(list_sum(f), {R}) AS fsum "
        f"FROM ({POINTS[dataset]}) s"
    )


def points_from_lines(dataset: str) -> str:
    """Round trip through 5-decimal text lines; aggregates per group (coordinates rounded as text)."""
    return (
        "SELECT grp, count(*) AS n, round(sum(round(f[1], 5)), 4) AS sum_x0, round(sum(round(f[2], 5)), 4) AS sum_x1 "
        f"FROM ({POINTS[dataset]}) s GROUP BY grp"
    )


def group_counts(dataset: str) -> str:
    return (
        "SELECT count(*) AS n, count(*) FILTER (WHERE grp = 'A') AS n_a, count(*) FILTER (WHERE grp <> 'A') AS n_b "
        f"FROM ({POINTS[dataset]}) s"
    )


def assign_nearest(dataset: str, k: int) -> str:
    return _with(
        _base(dataset, k) + [_assign("a", "c0")],
        f"SELECT p.id, a.grp, a.ci, round(a.d2, {R}) AS d2 FROM a JOIN pts p USING (rid)",
    )


def assign_nearest_large_k(dataset: str, k: int, offset: float) -> str:
    moved = f"SELECT id, grp, list_transform(f, lambda x: x + CAST({offset!r} AS DOUBLE)) AS f FROM ({POINTS[dataset]}) o"
    pts = f"pts AS MATERIALIZED (SELECT row_number() OVER () AS rid, id, grp, f FROM ({moved}) s)"
    return _with(
        [pts] + _base(dataset, k)[1:] + [_assign("a", "c0")],
        f"SELECT p.id, a.grp, a.ci, round(a.d2, {R}) AS d2 FROM a JOIN pts p USING (rid)",
    )


def objectives_at_init(dataset: str, k: int, what: str) -> str:
    """``what`` in {'delta', 'phi', 'all'}: objectives of the first-k centres."""
    ctes = _base(dataset, k) + [_assign("a", "c0"), _objectives("o", "a")]
    cols = {
        "delta": [f"round(o.s / o.n, {R}) AS delta"],
        "phi": [f"round({_phi('o')}, {R}) AS phi"],
        "all": ["o.n", "o.n_a", "o.n_b", f"round(o.s / o.n, {R}) AS delta", f"round({_phi('o')}, {R}) AS phi"],
    }[what]
    return _with(ctes, "SELECT " + ", ".join(cols) + " FROM o")


def cluster_group_stats(dataset: str, k: int) -> str:
    return _with(
        _base(dataset, k) + [_assign("a", "c0")],
        "SELECT c.ci, coalesce(s.n_a, 0) AS n_a, coalesce(s.n_b, 0) AS n_b FROM (SELECT DISTINCT ci FROM c0) c "
        "LEFT JOIN (SELECT ci, count(*) FILTER (WHERE grp = 'A') AS n_a, count(*) FILTER (WHERE grp = 'B') AS n_b "
        "FROM a GROUP BY ci) s USING (ci)",
    )


def kmeans_lloyd(dataset: str, k: int, rounds: int) -> str:
    ctes, fin = _chain("lloyd", "s", rounds)
    return _with(_base(dataset, k) + ctes, _long_centers(fin))


def clustering_report(dataset: str, k: int, rounds: int) -> str:
    ctes, fin = _chain("lloyd", "s", rounds)
    ctes = _base(dataset, k) + ctes + [_assign("fa", fin), _objectives("o", "fa")]
    return _with(
        ctes,
        f"SELECT o.n, o.n_a, o.n_b, round(o.s / o.n, {R}) AS delta, round({_phi('o')}, {R}) AS phi FROM o",
    )


def clustering_report_stats(dataset: str, k: int, rounds: int) -> str:
    ctes, fin = _chain("lloyd", "s", rounds)
    return _with(
        _base(dataset, k) + ctes + [_assign("fa", fin)],
        f"SELECT CAST(c.ci AS INTEGER) AS ci, CAST(c.j AS INTEGER) AS j, round(c.c, {R}) AS value, "
        "coalesce(s.n_a, 0) AS n_a, coalesce(s.n_b, 0) AS n_b "
        f"FROM {fin} c LEFT JOIN (SELECT ci, count(*) FILTER (WHERE grp = 'A') AS n_a, "
        "count(*) FILTER (WHERE grp = 'B') AS n_b FROM fa GROUP BY ci) s USING (ci)",
    )


def _draw(head: str, round_: int, seed: int) -> str:
    text = f"md5(CAST({head} AS VARCHAR) || ':{round_}:{seed}')"
    return f"(CAST(CAST('0x' || substr({text}, 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0)"


def _seeding(dataset: str, k: int, seed: int, steps: int) -> list[str]:
    """CTEs of :func:`_base`, with c0 the hash-drawn k-means|| seeding: every round and every pick unrolled."""
    one = f"SELECT rid FROM pts ORDER BY {_draw('id', 0, seed)}, id, f LIMIT 1"
    out = _base(dataset, k)[:2] + [f"q0 AS MATERIALIZED (SELECT 0 AS ci, j, x AS c FROM lf WHERE rid IN ({one}))"]
    for r in range(1, steps + 1):
        hit = f"{_draw('p.id', r, seed)} < {2.0 * k!r} * a.d2 / (SELECT sum(d2) FROM qa{r})"
        out += [
            _assign(f"qa{r}", f"q{r - 1}"),
            f"qn{r} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY id, f) + (SELECT max(ci) FROM q{r - 1}) AS ci, f "
            f"FROM (SELECT p.f, min(p.id) AS id FROM pts p JOIN qa{r} a USING (rid) WHERE {hit} GROUP BY p.f) t)",
            f"q{r} AS MATERIALIZED (SELECT ci, j, c FROM q{r - 1} UNION ALL "
            f"SELECT ci, unnest(range(len(f))) AS j, unnest(f) AS c FROM qn{r})",
        ]
    out += [
        _assign("qz", f"q{steps}"),
        f"qw AS MATERIALIZED (SELECT c.ci, count(z.rid) AS w FROM (SELECT DISTINCT ci FROM q{steps}) c "
        "LEFT JOIN qz z USING (ci) GROUP BY c.ci)",
        f"qd AS MATERIALIZED (SELECT a.ci AS a, b.ci AS b, sum((a.c - b.c) * (a.c - b.c)) AS d2 FROM q{steps} a "
        f"JOIN q{steps} b USING (j) GROUP BY a.ci, b.ci)",
    ]
    for i in range(k):
        mass = f"w * (SELECT min(d2) FROM qd WHERE a = qw.ci AND b IN (SELECT ci FROM h{i - 1}))" if i else "w"
        earlier = f"SELECT i, ci FROM h{i - 1} UNION ALL " if i else ""
        pick = _draw("'pick'", i, seed)
        out += [
            f"m{i} AS MATERIALIZED (SELECT ci, {mass} AS mass FROM qw)",
            f"h{i} AS MATERIALIZED ({earlier}SELECT {i} AS i, min(ci) AS ci FROM (SELECT ci, sum(mass) OVER (ORDER BY ci) "
            f"AS run, sum(mass) OVER () AS total FROM m{i}) t WHERE run > {pick} * total HAVING count(*) > 0)",
        ]
    return out + [f"c0 AS MATERIALIZED (SELECT h.i AS ci, q.j, q.c FROM h{k - 1} h JOIN q{steps} q USING (ci))"]


def kmeans_init(dataset: str, k: int, seed: int = 48, steps: int = 2) -> str:
    return _with(_seeding(dataset, k, seed, steps), _long_centers("c0"))


def kmeans_parallel(dataset: str, k: int, rounds: int, seed: int = 48, steps: int = 2) -> str:
    ctes, fin = _chain("lloyd", "s", rounds)
    return _with(_seeding(dataset, k, seed, steps) + ctes, _long_centers(fin))


def cluster_ab_outer_join(dataset: str, k: int) -> str:
    return _with(
        _base(dataset, k)
        + [
            _assign("a", "c0"),
            "sa AS (SELECT a.ci, lf.j, sum(lf.x) AS s, count(*) AS n FROM a JOIN lf USING (rid) WHERE a.grp = 'A' "
            "GROUP BY a.ci, lf.j)",
            "sb AS (SELECT a.ci, lf.j, sum(lf.x) AS s, count(*) AS n FROM a JOIN lf USING (rid) WHERE a.grp = 'B' "
            "GROUP BY a.ci, lf.j)",
        ],
        "SELECT CAST(coalesce(sa.ci, sb.ci) AS INTEGER) AS ci, CAST(coalesce(sa.j, sb.j) AS INTEGER) AS j, "
        "coalesce(sa.n, 0) AS n_a, coalesce(sb.n, 0) AS n_b, "
        f"round(coalesce(sa.s, 0), {R}) AS sum_a, round(coalesce(sb.s, 0), {R}) AS sum_b "
        "FROM sa FULL OUTER JOIN sb ON sa.ci = sb.ci AND sa.j = sb.j",
    )


def fair_cluster_stats(dataset: str, k: int) -> str:
    return _with(
        _base(dataset, k) + [f"fc0 AS (SELECT * FROM c0)"] + _fair_stats("f", 0),
        f"SELECT cl.ci, CAST(cl.j AS INTEGER) AS j, k.n_a, k.n_b, round(k.alpha, {R}) AS alpha, round(k.beta, {R}) AS beta, "
        f"round(k.ell, {R}) AS ell, round(cl.mu_a, {R}) AS mu_a, round(cl.mu_b, {R}) AS mu_b "
        "FROM fcl0 cl JOIN fk0 k USING (ci)",
    )


def fair_scatter(dataset: str, k: int) -> str:
    return _with(
        _base(dataset, k) + [f"fc0 AS (SELECT * FROM c0)"] + _fair_stats("f", 0),
        f"SELECT round(fixed_a, {R}) AS fixed_a, round(fixed_b, {R}) AS fixed_b FROM ffx0",
    )


def fair_balance(dataset: str, k: int) -> str:
    return _with(
        _base(dataset, k) + [f"fc0 AS (SELECT * FROM c0)"] + _fair_stats("f", 0) + _balance("f", 0),
        "SELECT c.ci, round(coalesce(x.x, 0.0), 6) AS x FROM (SELECT DISTINCT ci FROM c0) c "
        "LEFT JOIN fx0_10 x USING (ci)",
    )


def fair_step(dataset: str, k: int) -> str:
    ctes, fin = _chain("fair", "f", 1)
    return _with(_base(dataset, k) + ctes, _long_centers(fin))


def fair_lloyd(dataset: str, k: int, rounds: int) -> str:
    ctes, fin = _chain("fair", "f", rounds)
    return _with(_base(dataset, k) + ctes, _long_centers(fin))


def fair_vs_standard(dataset: str, k: int, rounds: int, seeded: bool = False) -> str:
    s_ctes, s_fin = _chain("lloyd", "s", rounds)
    f_ctes, f_fin = _chain("fair", "f", rounds)
    ctes = (
        (_seeding(dataset, k, 48, 2) if seeded else _base(dataset, k))
        + s_ctes
        + f_ctes
        + [_assign("sfa", s_fin), _objectives("so", "sfa"), _assign("ffa", f_fin), _objectives("fo", "ffa")]
    )
    return _with(
        ctes,
        f"SELECT so.n, so.n_a, so.n_b, round({_phi('so')}, {R}) AS phi_standard, round({_phi('fo')}, {R}) AS phi_fair "
        "FROM so, fo",
    )


# ---------------------------------------------------------------------------------------------------------------
# Word count
# ---------------------------------------------------------------------------------------------------------------

WORDS = (
    "words AS (SELECT doc_id, unnest(CASE WHEN text = '' OR rtrim(text, ' ') <> '' "
    "THEN string_split(rtrim(text, ' '), ' ') ELSE CAST([] AS VARCHAR[]) END) AS word FROM documents)"
)


def doc_count() -> str:
    return "SELECT count(*) AS n_docs FROM documents"


def word_count() -> str:
    return _with([WORDS], "SELECT word, count(*) AS n FROM words GROUP BY word")


def word_count_files() -> str:
    line = "translate(coalesce(text, ''), chr(13) || chr(10), '  ')"
    words = WORDS.replace("FROM documents", f"FROM (SELECT doc_id, {line} AS text FROM documents) d")
    return _with([words], "SELECT word, count(*) AS n FROM words GROUP BY word")


def word_count_per_doc() -> str:
    return _with([WORDS], "SELECT doc_id, word, count(*) AS n FROM words GROUP BY doc_id, word")


def distinct_words() -> str:
    return _with([WORDS], "SELECT count(DISTINCT word) AS n_words FROM words")


def avg_word_length() -> str:
    utf16 = r"length(word) + length(regexp_replace(word, '[^\x{10000}-\x{10FFFF}]', '', 'g'))"
    return _with(
        [WORDS, "dw AS (SELECT DISTINCT word FROM words)"],
        f"SELECT count(*) AS n_words, round(avg({utf16}), {R}) AS avg_length FROM dw",
    )


# ---------------------------------------------------------------------------------------------------------------
# Items, frequencies and sketches
# ---------------------------------------------------------------------------------------------------------------

PARSE = "CASE WHEN regexp_full_match(value, '[+-]?[0-9]+') THEN TRY_CAST(value AS BIGINT) END"

ITEM_SOURCES = {
    "lineitem_partkey": "SELECT CAST(l_partkey AS VARCHAR) AS value, NULL AS batch FROM lineitem",
    "lineitem_orderkey": "SELECT CAST(l_orderkey AS VARCHAR) AS value, NULL AS batch FROM lineitem",
    "events": "SELECT CAST(user_id AS VARCHAR) AS value, CAST(ts AS DATE) AS batch FROM events",
}


def _items(source: str) -> str:
    return f"items AS MATERIALIZED (SELECT value, batch, {PARSE} AS item FROM ({ITEM_SOURCES[source]}) s)"


def _bounded(source: str, threshold: int) -> list[str]:
    """Keep a batch iff the items of earlier batches number fewer than ``threshold``."""
    return [
        _items(source),
        "bs AS (SELECT batch, count(*) AS size FROM items GROUP BY batch)",
        "bw AS (SELECT batch, size, coalesce(sum(size) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS before FROM bs)",
        f"kept AS (SELECT items.* FROM items JOIN bw USING (batch) WHERE bw.before < {threshold})",
    ]


def items_parse() -> str:
    return (
        "SELECT event_id, value, "
        + PARSE
        + " AS item FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN props ELSE CAST(user_id AS VARCHAR) "
        "END AS value FROM events) s"
    )


def _hashes(fam: HashFamily) -> str:
    vals = ", ".join(
        f"({r.row}, {r.a_cm}, {r.b_cm}, {r.a_cs}, {r.b_cs}, {r.a_sg}, {r.b_sg})" for r in fam.rows
    )
    return f"hashes(row, a_cm, b_cm, a_cs, b_cs, a_sg, b_sg) AS (VALUES {vals})"


def _h(a: str, b: str, x: str, c: int | str, p: int) -> str:
    return f"((({a} * ((({x} % {p}) + {p}) % {p}) + {b}) % {p}) % {c})"


def _sketch_ctes(fam: HashFamily, src: str = "items") -> list[str]:
    p, w = fam.prime, fam.width
    hcm = _h("h.a_cm", "h.b_cm", "i.item", w, p)
    hcs = _h("h.a_cs", "h.b_cs", "i.item", w, p)
    sg = f"CASE WHEN {_h('h.a_sg', 'h.b_sg', 'i.item', 2, p)} = 0 THEN -1 ELSE 1 END"
    return [
        _hashes(fam),
        f"cm AS MATERIALIZED (SELECT CAST(h.row AS INTEGER) AS row, CAST({hcm} AS BIGINT) AS col, "
        f"CAST(count(*) AS BIGINT) AS v FROM {src} i, hashes h WHERE i.item IS NOT NULL GROUP BY 1, 2)",
        f"cs AS MATERIALIZED (SELECT CAST(h.row AS INTEGER) AS row, CAST({hcs} AS BIGINT) AS col, "
        f"CAST(sum({sg}) AS BIGINT) AS v FROM {src} i, hashes h WHERE i.item IS NOT NULL GROUP BY 1, 2)",
    ]


def _topk_ctes(k: int, src: str = "items") -> list[str]:
    return [
        f"freq AS MATERIALIZED (SELECT item, count(*) AS n FROM {src} WHERE item IS NOT NULL GROUP BY item)",
        f"thr AS (SELECT min(n) AS t FROM (SELECT n FROM freq ORDER BY n DESC LIMIT {k}) s)",
        "topk AS MATERIALIZED (SELECT item, n FROM freq WHERE n >= (SELECT t FROM thr))",
    ]


def _estimate_ctes(fam: HashFamily, keys: str = "topk") -> list[str]:
    p, w, d = fam.prime, fam.width, fam.depth
    hcm = _h("h.a_cm", "h.b_cm", "i.item", w, p)
    hcs = _h("h.a_cs", "h.b_cs", "i.item", w, p)
    sg = f"CASE WHEN {_h('h.a_sg', 'h.b_sg', 'i.item', 2, p)} = 0 THEN -1 ELSE 1 END"
    return [
        f"est_cm AS (SELECT i.item, min(coalesce(c.v, 0)) AS est_cm FROM {keys} i CROSS JOIN hashes h "
        f"LEFT JOIN cm c ON c.row = h.row AND c.col = {hcm} GROUP BY i.item)",
        f"est_cs AS (SELECT item, list_sort(list(e))[{d // 2 + 1}] AS est_cs FROM (SELECT i.item, "
        f"coalesce(c.v, 0) * ({sg}) AS e FROM {keys} i CROSS JOIN hashes h LEFT JOIN cs c ON c.row = h.row AND "
        f"c.col = {hcs}) s GROUP BY item)",
    ]


def item_frequency(source: str) -> str:
    return _with([_items(source)], "SELECT item, count(*) AS n FROM items WHERE item IS NOT NULL GROUP BY item")


def top_k(source: str, k: int) -> str:
    return _with([_items(source)] + _topk_ctes(k), "SELECT item, n FROM topk")


def count_min_cells(source: str, fam: HashFamily) -> str:
    return _with([_items(source)] + _sketch_ctes(fam), "SELECT row, col, v FROM cm")


def count_sketch_cells(source: str, fam: HashFamily) -> str:
    return _with([_items(source)] + _sketch_ctes(fam), "SELECT row, col, v FROM cs")


def _all_items_estimates(source: str, fam: HashFamily) -> list[str]:
    return (
        [_items(source)]
        + _sketch_ctes(fam)
        + ["keys AS (SELECT DISTINCT item FROM items WHERE item IS NOT NULL)"]
        + _estimate_ctes(fam, "keys")
    )


def count_min_estimate(source: str, fam: HashFamily) -> str:
    return _with(_all_items_estimates(source, fam), "SELECT item, CAST(est_cm AS BIGINT) AS est_cm FROM est_cm")


def count_sketch_estimate(source: str, fam: HashFamily) -> str:
    return _with(_all_items_estimates(source, fam), "SELECT item, CAST(est_cs AS BIGINT) AS est_cs FROM est_cs")


def _report_ctes(source: str, fam: HashFamily, k: int, bounded: int | None = None) -> list[str]:
    if bounded is None:
        head, src = [_items(source)], "items"
    else:
        head, src = _bounded(source, bounded), "kept"
    return (
        head
        + _sketch_ctes(fam, src)
        + _topk_ctes(k, src)
        + _estimate_ctes(fam)
        + [
            "rep AS (SELECT t.item, t.n, CAST(m.est_cm AS BIGINT) AS est_cm, CAST(s.est_cs AS BIGINT) AS est_cs, "
            "abs(t.n - m.est_cm) / t.n AS err_cm, abs(t.n - s.est_cs) / t.n AS err_cs "
            "FROM topk t JOIN est_cm m USING (item) JOIN est_cs s USING (item))"
        ]
    )


def hh_error_report(source: str, fam: HashFamily, k: int) -> str:
    return _with(
        _report_ctes(source, fam, k),
        f"SELECT item, n, est_cm, est_cs, round(err_cm, {R}) AS err_cm, round(err_cs, {R}) AS err_cs FROM rep",
    )


def hh_summary(source: str, fam: HashFamily, k: int, bounded: int | None = None) -> str:
    src = "items" if bounded is None else "kept"
    return _with(
        _report_ctes(source, fam, k, bounded),
        f"SELECT (SELECT count(*) FROM {src}) AS processed, (SELECT count(*) FROM freq) AS n_distinct, "
        f"(SELECT count(*) FROM topk) AS n_top, (SELECT round(avg(err_cm), {R}) FROM rep) AS avg_err_cm, "
        f"(SELECT round(avg(err_cs), {R}) FROM rep) AS avg_err_cs",
    )


def hh_listing(source: str, fam: HashFamily, k: int) -> str:
    return _with(_report_ctes(source, fam, k), "SELECT item, n, est_cm FROM rep")


def bounded_stream(source: str, threshold: int) -> str:
    return _with(
        _bounded(source, threshold),
        f"SELECT CAST(batch AS VARCHAR) AS batch, size, CAST(before AS BIGINT) AS before FROM bw "
        f"WHERE before < {threshold}",
    )


def bounded_stream_run(source: str, threshold: int) -> str:
    """The batches in order, numbered from 0."""
    return _with(
        _bounded(source, threshold),
        "SELECT batch_id, size, CAST(before AS BIGINT) AS before FROM (SELECT *, row_number() OVER (ORDER BY batch) - 1 "
        f"AS batch_id FROM bw) t WHERE before < {threshold}",
    )
