from __future__ import annotations

import random
import re

import numpy as np
from pyspark.sql import functions as F

from tillmark.llm import minhash
from tillmark.llm.minhash import jaccard_groups, op12_minhash, permuted, shingles, signature


def plain_groups(items, shingle=2):
    """Smallest id of each component of texts that share 80 percent of their shingles; texts without a word stay alone."""
    def of(text):
        words = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        return frozenset(" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))) if words else frozenset()

    sets = [(i, of(t)) for i, t in items]
    root = {i: i for i, _ in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = top(i), top(j)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), top(i)) for i, s in sets}


def test_a_group_of_which_many_are_linked_through_others_only(make, spark, tmp_path):
    random.seed(2)
    word = lambda: f"w{random.randint(0, 2000)}"
    base = [word() for _ in range(120)]
    rows = []
    for _ in range(600):
        words = list(base)
        for _ in range(random.randint(1, 9)):
            words[random.randrange(len(words))] = word()
        rows.append(" ".join(words))
    for _ in range(60):
        text = [word() for _ in range(random.randint(1, 60))]
        rows += [" ".join(text), " ".join(text[:-1] + [word()]), " ".join(text).upper(), " ".join(base[:30] + text)]
    rows += ["", None, " \t", "one", "ONE", "one two", "Ünï ünï", "ünï ünï"]
    random.shuffle(rows)
    make([(i, t, "en", "a") for i, t in enumerate(rows)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op12_minhash(spark, str(tmp_path)).collect()}
    assert got == plain_groups(list(enumerate(rows)))


def test_slices_do_not_change_the_links(make, monkeypatch):
    random.seed(8)
    base = [f"w{i}" for i in range(100)]
    rows = [" ".join(random.choice((w, w, w, w, w, w, w, w, w, w, w, f"x{random.randint(0, 999)}")) for w in base) for _ in range(200)]
    docs = make([(i, t, None, None) for i, t in enumerate(rows)])
    want = {}
    for i, (_, root) in plain_groups(list(enumerate(rows))).items():
        want.setdefault(root, set()).add(i)
    for size in (7, 512):
        monkeypatch.setattr(minhash, "SLICE", size)
        got = {}
        for r in jaccard_groups(docs, F.col("doc_id")).collect():
            got.setdefault(r.root, set()).add(r.key)
        assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_permutations_and_signatures():
    few = np.arange(1 << 16, dtype=np.uint32) * np.uint32(65537)
    assert len(np.unique(permuted(few.copy(), 0x85EBCA6B, 0xC2B2AE35))) == len(few)
    text = " ".join(f"w{i}" for i in range(3000))
    found = shingles(text, 2)
    one = np.minimum.reduce([signature(found[i:i + 100]) for i in range(0, len(found), 100)])
    assert (signature(found) == one).all() and len(found) == 2999 and len(shingles(" ", 2)) == 0
    near = shingles(text.replace("w7 ", "x ").replace("w77 ", "y "), 2)
    alike = len(np.intersect1d(found, near)) / len(np.union1d(found, near))
    assert abs((signature(found) == signature(near)).mean() - alike) < 0.05


def test_odd_rows(odd, none, spark, tmp_path):
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    got = op12_minhash(spark, str(tmp_path)).collect()
    assert len(got) == odd.count()
    by = {r.doc_id: r for r in got}
    assert {i: by[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)} == {1: 1, 2: 2, 3: 3, 4: 3, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9}
    assert by[None].component_id is None and not by[None].kept and by[1].n_shingles == 0 and by[1].kept
    none.write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op12_minhash(spark, f"{tmp_path}/none").isEmpty()


def test_null_and_repeated_ids_do_not_hide_links(make, spark, tmp_path):
    """Near copies of which one has no id, and ids that come with several texts."""
    word = lambda i, n=40: " ".join(f"w{i}x{k}" for k in range(n))
    rows = [(None, word(1) + " end", None, None), (5, word(1), None, None), (7, word(2), None, None), (7, word(3), None, None),
            (7, word(4), None, None), (9, word(3) + " tail", None, None), (None, word(5), None, None), (None, word(5) + " z", None, None)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in op12_minhash(spark, str(tmp_path)).collect()), key=repr)
    want = [(5, 39, 5, True), (7, 39, 7, True), (7, 39, 7, True), (7, 39, 7, True), (9, 40, 7, False),
            (None, 39, None, False), (None, 40, 5, False), (None, 40, None, False)]
    assert got == sorted(want, key=repr)
