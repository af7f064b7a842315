from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillmark.llm import minhash
from tillmark.llm.similar import SHINGLE, keep_one_per_similar, similar_groups


def plain_shingles(text):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    return frozenset(" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def plain_kept(items):
    """The smallest id of each component of texts with similarity 0.8 or more."""
    groups = []
    for i, text in items:
        s = plain_shingles(text)
        near = [g for g in groups if any(len(s & x) * 5 >= len(s | x) * 4 for _, x in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [(i, s)]]
    return sorted(min(i for i, _ in g) for g in groups)


@pytest.fixture(scope="module")
def copies(make):
    """Texts, each with copies that have some words changed, many copies of one, and a passage that many others share."""
    random.seed(5)
    word = lambda: f"w{random.randint(0, 3000)}"
    passage, rows = " ".join(word() for _ in range(40)), []
    def changed(words, n):
        words = list(words)
        for _ in range(n):
            words[random.randrange(len(words))] = word()
        return words
    for _ in range(25):
        base = [word() for _ in range(random.randint(5, 200))]
        rows += [base, *(changed(base, random.randint(0, 1 + len(base) // 30)) for _ in range(3))]
    hot = [word() for _ in range(120)]
    rows += [hot, *(changed(hot, random.randint(1, 4)) for _ in range(50))]
    rows += [[*passage.split(), *(word() for _ in range(random.randint(0, 30)))] for _ in range(30)]
    random.shuffle(rows)
    return make([(i, " ".join(w), "en", "a") for i, w in enumerate(rows)]).persist()


def test_the_stage_links_all_texts_that_are_similar(copies, spark):
    want = plain_kept([(r.doc_id, r.text) for r in copies.collect()])
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, copies, "")
    assert got.columns == copies.columns and sorted(r.doc_id for r in got.collect()) == want


def test_groups_equal_brute_force(copies):
    groups = {}
    for r in similar_groups(copies.select("doc_id", "text"), "doc_id").collect():
        groups.setdefault(r.root, []).append(r.doc_id)
    assert sorted(map(min, groups.values())) == plain_kept([(r.doc_id, r.text) for r in copies.collect()])


def test_fingerprints_link_by_themselves(make, monkeypatch):
    """With one band of all coordinates, the stage still links texts whose fingerprints are two bits apart at most."""
    monkeypatch.setattr(minhash, "ROWS", 1000)
    monkeypatch.setattr(minhash, "_alike", lambda percent: F.lit(True))
    random.seed(3)
    texts = []
    for _ in range(10):
        words = [f"w{random.randint(0, 3000)}" for _ in range(900)]
        texts += [" ".join([*words[:at], "changed", *words[at + 1:]]) for at in random.sample(range(900), 3)]
    bits = [minhash.folded(minhash.shingles(t, SHINGLE)) for t in texts]
    root = {r.doc_id: r.root for r in similar_groups(make([(i, t, "en", "a") for i, t in enumerate(texts)]), "doc_id").collect()}
    near = [(i, j) for i in range(30) for j in range(i) if i // 3 == j // 3 and (bits[i] ^ bits[j]).bit_count() <= 2]
    assert len(near) > 5 and all(root[i] == root[j] for i, j in near)


def test_a_thousand_near_copies(make):
    """Copies of one text that are partly too far from each other, so that some are linked through others only."""
    random.seed(9)
    base = [f"w{random.randint(0, 5000)}" for _ in range(150)]
    texts = []
    for _ in range(1000):
        words = list(base)
        for _ in range(random.randint(1, 5)):
            words[random.randrange(len(words))] = f"x{random.randint(0, 5000)}"
        texts.append(" ".join(words))
    kept = keep_one_per_similar(make([(i, t, "en", "a") for i, t in enumerate(texts)]))
    assert sorted(r.doc_id for r in kept.collect()) == plain_kept(list(enumerate(texts)))


def test_odd_rows(odd, none):
    kept = keep_one_per_similar(odd)
    # 1, 2 and 5 have no word, 3 and 4 one text, 6 and 7 nearly one.
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 3, 6, 8, 9]
    assert keep_one_per_similar(none).isEmpty()
