from __future__ import annotations

import hashlib
import random
import re

import xxhash
from pyspark.sql import functions as F

from tillmark.llm.winnow import (
    GRAM, LONGEST, PLACE_BITS, WINDOW, compare_with_edits, digest, fingerprints, hash_of, place_of, successors)


def word_hash(word):
    value = xxhash.xxh64_intdigest(word.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def gram_hash(hashes):
    """Spark hashes an array element by element, each seeded with the hash so far."""
    seed = 42
    for h in hashes:
        seed = xxhash.xxh64_intdigest((h & (2 ** 64 - 1)).to_bytes(8, "little"), seed)
    return seed


def plain_marks(text):
    """(place, hash) by windows over all grams, the rightmost of the least."""
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = []
    for w in re.findall(r"[^\x20\x09-\x0d]+", text):
        words += [word_hash(w[i:i + LONGEST]) for i in range(max(1, len(w) - LONGEST + 1))]
    if not words:
        return []
    grams = [gram_hash(words[i:i + GRAM]) for i in range(max(1, len(words) - GRAM + 1))]
    signed = [(g - (1 << 64) if g >> 63 else g) >> PLACE_BITS for g in grams]
    out = {}
    for i in range(max(1, len(signed) - WINDOW + 1)):
        window = signed[i:i + WINDOW]
        best = max(j for j, h in enumerate(window) if h == min(window))
        out[i + best + 1, window[best]] = True
    return list(out)


def near(a, b):
    a, b = {h for _, h in plain_marks(a)}, {h for _, h in plain_marks(b)}
    return len(a & b) / len(a | b) if a | b else 1.0


def test_marks_equal_brute_force(odd, rows):
    short = odd.filter("n_chars < 1000")
    shown = fingerprints(short).select("doc_id", F.transform("marks", lambda m: F.struct(place_of(m), hash_of(m))).alias("m"))
    assert sorted((r.doc_id or 0, [tuple(x) for x in r.m]) for r in shown.collect()) == sorted(
        (r.doc_id or 0, plain_marks(r.text)) for r in short.collect())


def test_the_rightmost_of_equal_grams_is_marked(make):
    text = "a " * 40
    marks = fingerprints(make([(1, text, None, None)])).select(F.transform("marks", place_of).alias("p")).first().p
    assert marks == [p for p, _ in plain_marks(text)] == list(range(WINDOW, 40 - GRAM + 2))


def test_edits_and_likeness_equal_brute_force(odd, rows):
    docs = sorted({(r.doc_id, r.text or "") for r in odd.collect()}, key=lambda d: (
        d[0] is None, -(d[0] or 0), hashlib.sha256(d[1].encode()).hexdigest()))
    want = []
    for n, (i, text) in enumerate(docs):
        follow, third = docs[(n + 1) % len(docs)][1], len(text) // 3
        edited = text[:len(text) - third] + follow[:third]
        want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near(text, edited), 9), round(near(text, follow), 9)))
    got = compare_with_edits(odd).withColumns({c: F.round(c, 9) for c in ("near_edited", "near_next")})
    assert rows(got, "doc_id", "n_chars", "edited_sha256", "near_edited", "near_next") == sorted(want, key=repr)


def test_order_is_followed_across_partitions(spark, make):
    docs = make([(i, f"text {i}", None, None) for i in range(500)]).repartition(7)
    follow = {r.key.doc_id: r.next.doc_id for r in successors(docs).collect()}
    assert follow == {i: (i - 1) % 500 for i in range(500)}


def test_shared_runs_share_a_mark(make):
    run = " ".join(f"shared{i}" for i in range(GRAM + WINDOW - 1))
    docs = make([(1, f"quite another beginning {run} and an end", None, None), (2, f"no {run}", None, None)])
    first, second = ({x >> PLACE_BITS for x in r.marks} for r in fingerprints(docs).collect())
    assert first & second


def test_equal_texts_have_equal_digests_and_a_single_one_follows_itself(make):
    docs = make([(1, "Some words to be looked at here", None, None), (2, "Some words to be looked at here", None, None)])
    assert fingerprints(docs).select(digest(F.col("marks"))).distinct().count() == 1
    assert compare_with_edits(docs.limit(1)).first().near_next == 1.0


def test_no_rows_give_no_rows(none):
    assert compare_with_edits(none).isEmpty()


def test_text_without_spaces_shares_marks_at_every_shift(make):
    """A run of LONGEST + GRAM + WINDOW - 2 shared characters is enough, wherever it begins."""
    random.seed(3)
    base = "".join(random.choices("abcdefgh漢字", k=600))
    shared = base[100:100 + LONGEST + GRAM + WINDOW - 2]
    texts = [base] + [base[-i:] + base for i in range(1, 18)] + ["".join(random.choices("xyz", k=40 + i)) + shared + "x" * i for i in range(10)]
    marked = [{hash_of_mark for _, hash_of_mark in plain_marks(t)} for t in texts]
    assert all(len(marked[0] - m) <= 1 for m in marked[1:18]) and all(marked[0] & m for m in marked[18:])
    found = fingerprints(make([(i, t, None, None) for i, t in enumerate(texts)])).select(
        "doc_id", F.transform("marks", lambda m: F.struct(place_of(m), hash_of(m))).alias("m"))
    assert {r.doc_id: [tuple(x) for x in r.m] for r in found.collect()} == {i: plain_marks(t) for i, t in enumerate(texts)}
