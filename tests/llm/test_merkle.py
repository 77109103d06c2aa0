"""The Merkle manifest against a plain recomputation, round by round."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from llm_support import SCHEMA, odd_rows

from spindle.llm import merkle


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = ("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc_id, source, lang, n_chars, text))
    return h(*fields)


def climb(nodes):
    """All levels from ``nodes`` to the one node left."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return levels


def path(levels, i):
    """The rest of every run on the way up: ``(left, right)``."""
    out = []
    for level in levels[:-1]:
        run = i - i % 2
        out.append(("".join(level[run:i]), "".join(level[i + 1 : run + 2])))
        i //= 2
    return out


def brute(rows):
    by_lang = {}
    for doc_id, text, lang, source, n_chars in rows:
        own = leaf(doc_id, text, lang, source, n_chars)
        bad = doc_id is not None and n_chars is not None and zlib.crc32(str(doc_id).encode()) % merkle.TAMPER == 0
        start = leaf(doc_id, text, lang, source, n_chars + 1) if bad else own
        by_lang.setdefault(lang, []).append((doc_id is not None, doc_id or 0, own, doc_id, start))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: climb([r[2] for r in sorted(by_lang[x])]) for x in langs}
    top = climb([trees[x][-1][0] for x in langs])
    out = []
    for k, x in enumerate(langs):
        for i, (_, _, own, doc_id, start) in enumerate(sorted(by_lang[x])):
            way = path(trees[x], i) + path(top, k)
            root = start
            for left, right in way:
                root = h(left, root, right)
            proof = h(*(s for pair in way for s in pair))
            out.append((doc_id, own, trees[x][-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return out


def check(df, rows):
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in r)
    got = sorted((tuple(r) for r in merkle.verified_manifest(df).collect()), key=key)
    assert got == sorted(brute(rows), key=key)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_every_block_size_gives_the_same_manifest(spark, monkeypatch, levels):
    """Small blocks make many rounds; the trees do not depend on it."""
    monkeypatch.setattr(merkle, "ROUND", levels)
    monkeypatch.setattr(merkle, "BLOCK", 1 << levels)
    rows = [(i, f"text {i} é", ["en", "de", None, "zz", "ü"][(i > 20) + (i > 57) + (i > 58) + (i > 60)], "s", i) for i in range(64)]
    check(spark.createDataFrame(rows, SCHEMA).repartition(5), rows)


def test_odd_rows(odd):
    check(odd, odd_rows())


def test_one_hot_row(spark):
    """A third of all rows is one repeated row: its copies are leaves of their own."""
    rows = [(i, "same" if i % 3 else None, "en", None, None if i % 5 else i) for i in range(400)] + [(7, "copy", "en", "s", 4)] * 200
    check(spark.createDataFrame(rows, SCHEMA).repartition(3), rows)


def test_single_row_and_empty_table(spark, empty):
    rows = [(5, "", None, "", 0)]
    check(spark.createDataFrame(rows, SCHEMA), rows)
    assert merkle.verified_manifest(empty).count() == 0


def test_paths_prove_rows(spark, docs):
    """Every path leads from its own leaf to the one root, and from another leaf elsewhere."""
    found = merkle.manifest(docs).where("doc_id % 20 = 0").collect()
    assert len({r["root"] for r in found}) == 1
    for r in found:
        for start, proves in ((r["leaf"], True), (h("another"), False)):
            for left, right in r["path"]:
                start = h(left, start, right)
            assert (start == r["root"]) is proves
