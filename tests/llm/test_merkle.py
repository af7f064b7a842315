from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillmark.llm import merkle
from tillmark.llm.merkle import climb, folded, manifest, missing, op13_merkle_manifest, parent

H = lambda *parts: hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([H(*out[-1][i:i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(levels, place):
    """(digest or None, whether it comes before) level by level."""
    return [(nodes[place >> n ^ 1] if place >> n ^ 1 < len(nodes) else None, bool(place >> n & 1)) for n, nodes in enumerate(levels[:-1])]


def plain(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of rows (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r))):
        trees.setdefault(r[2], []).append(r)
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    lower = {x: levels_of([plain_leaf(r) for r in trees[x]]) for x in langs}
    upper = levels_of([lower[x][-1][0] for x in langs])
    out = []
    for at, x in enumerate(langs):
        for place, r in enumerate(trees[x]):
            path = siblings(lower[x], place) + siblings(upper, at)
            changed = r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = plain_leaf((*r[:3], r[3] + 1, r[4])) if changed else plain_leaf(r)
            for other, before in path:
                node = H(node) if other is None else H(other, node) if before else H(node, other)
            out.append((r[0], lower[x][0][place], lower[x][-1][0], upper[-1][0], H(*(o or "" for o, _ in path)), node, node == upper[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 3, 12])
def test_equals_brute_force_at_every_height(odd, make, spark, tmp_path, monkeypatch, height):
    monkeypatch.setattr(merkle.manifest, "__defaults__", (height,))
    many = make([(i, f"Text {i}", ("en", "de", None, "zh", "ü")[i % 11 % 5], "s") for i in range(20, 120)])
    docs = odd.unionAll(many)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    got = sorted(map(tuple, op13_merkle_manifest(spark, str(tmp_path)).collect()), key=repr)
    assert got == plain(rows) and {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("n", [1, 2, 3, 7, 8])
def test_one_language(make, spark, tmp_path, n):
    docs = make([(i, None, None, None) for i in range(n)])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    assert sorted(map(tuple, op13_merkle_manifest(spark, str(tmp_path)).collect()), key=repr) == plain(rows)


def test_no_rows(none):
    assert manifest(none).isEmpty()


def test_the_union_of_missing_nodes_is_least():
    leaves = [bytes([i]) * 32 for i in range(13)]
    whole = climb(dict(enumerate(leaves)), 13, {})
    for places in ([0], [12], [3, 4], [0, 1, 2, 3], [5, 12], list(range(13))):
        wanted = missing(np.array(places), 13)
        fetched = {(level, i): whole[level][i] for level, i in wanted}
        assert climb({i: leaves[i] for i in places}, 13, fetched)[-1] == whole[-1]
        for left_out in wanted:
            fewer = {k: v for k, v in fetched.items() if k != left_out}
            with pytest.raises(KeyError):
                climb({i: leaves[i] for i in places}, 13, fewer)
    assert missing(np.arange(13), 13) == [] and len(missing(np.array([0]), 13)) == 4
    assert parent([b"a"]) == hashlib.sha256(b"61").digest()


def test_a_changed_row_is_found(make):
    docs = make([(i, f"Text {i}", "en", "s") for i in range(9)])
    changed = manifest(docs, other=merkle.digest_of(text=F.lit("Text 4")))
    got = {r.doc_id: (r.same, r.forged) for r in changed.select(
        "doc_id", (folded(F.col("leaf"), F.col("proof")) == F.lower(F.hex("root"))).alias("same"),
        (folded(F.col("other"), F.col("proof")) == F.lower(F.hex("root"))).alias("forged")).collect()}
    assert got == {i: (True, i == 4) for i in range(9)}
