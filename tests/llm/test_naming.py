from __future__ import annotations

import hashlib
from collections import Counter

from pyspark.sql import functions as F

from tillmark.llm.naming import drop_exact_duplicates, exact_duplicates, text_identities


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def test_odd_rows_count_once_and_equal_texts_meet(odd, rows):
    docs = {(r.doc_id, lowered(r.text)) for r in odd.collect()}
    sizes = Counter(t for _, t in docs)
    want = []
    for i, t in docs:
        keep = max((d for d, u in docs if u == t and d is not None), default=None)
        want.append((i, keep, sizes[t], i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert rows(exact_duplicates(odd, 64), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == sorted(want, key=repr)


def test_no_rows_give_no_rows(none):
    assert exact_duplicates(none).isEmpty() and drop_exact_duplicates(none).isEmpty()


def test_block_size_does_not_matter(odd, rows):
    for block in (1000, 1_000_000):
        assert rows(exact_duplicates(odd, block), "doc_id", "keep_id") == rows(exact_duplicates(odd, 300), "doc_id", "keep_id")


def test_contents_with_one_fingerprint_are_told_apart(make, rows):
    docs = make([(i, t, None, None) for i, t in enumerate(["ab", "ba", "AB", "abcd", "cdab", "abab", "abcda", ""])])
    by_length = exact_duplicates(docs, 2, fingerprint=lambda block: F.length(block).cast("long"))
    assert rows(by_length, "doc_id", "keep_id") == rows(exact_duplicates(docs, 2), "doc_id", "keep_id") == [
        (0, 2), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7)]


def test_names_are_the_same_in_every_run(odd, rows):
    once, again = (rows(text_identities(odd.repartition(n), 100), "doc_id", "_level", "_name") for n in (2, 5))
    assert once == again


def test_kept_rows_keep_their_columns(odd):
    kept = drop_exact_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0, r.kind) for r in kept.collect()) == [(0, "x"), *((i, "x") for i in (2, 4, 5, 6, 7, 8, 9))]
