from __future__ import annotations

import random
import zlib

import numpy as np

from tillmark.llm import toxicity as tox
from tillmark.llm.toxicity import Model, fit, score_texts, subsequences, tokens

BAD = ["scoundrel", "rotter", "blaggard"]
GOOD = "the and house garden over under water light green paper table window letter river stone".split()


def corpus(make, spark, n=400):
    random.seed(5)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        words = [random.choice(GOOD) + random.choice(["", "s", "er", "ing"]) for _ in range(25)]
        if toxic:
            words[random.randrange(25)] = random.choice(BAD) + random.choice(["", "s", "ish"])
        rows.append((i, " ".join(words) + ".", "en", "a"))
        labels.append((i, 1, int(toxic)))
    return make(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_documents_are_told_apart(make, spark):
    docs, labels = corpus(make, spark)
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    found = [r for r in score_texts(docs.select("doc_id", "text"), docs, labels).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert len(found) > 50 and np.mean([r.predicted == truth[r.doc_id] for r in found]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_labels_of_held_out_rows_do_not_matter(make, spark, rows):
    docs, labels = corpus(make, spark, 120)
    turned = labels.selectExpr("doc_id", "quality", "if(crc32(cast(string(doc_id) as binary)) % 5 = 0, 1 - toxic, toxic) as toxic")
    slim = docs.select("doc_id", "text")
    assert rows(score_texts(slim, docs, labels), "doc_id", "score") == rows(score_texts(slim, docs, turned), "doc_id", "score")


def test_kernel_weights_equal_the_definition():
    word = "^abcab$"
    want: dict = {}
    for i in range(len(word)):
        for k in range(i + 2, min(len(word), i + tox.SPAN)):
            for j in range(i + 1, k):
                key = (word[i], word[j], word[k])
                want[key] = want.get(key, 0) + tox.DECAY ** (k - i - 2)
    [(_, codes, weights, starts)] = subsequences([word])
    assert len(codes) == len(want) and list(starts) == [0]
    assert np.allclose(sorted(weights), sorted(want.values()))


def test_insults_with_inserted_characters_are_found():
    random.seed(2)
    rows = [(int(i % 3 == 0), [{random.choice(GOOD) for _ in range(8)}, {random.choice(GOOD), random.choice(BAD) if i % 3 == 0 else "stone"}])
            for i in range(300)]
    model = fit(rows)
    bad = model.scores(["you scoundrel", "you s.c.o.u.n.d.r.e.l", "s c o u n d r e l", "scoun-drel!", "SCOUNDREL", "scoundrels", "scounxdrel"])
    assert (bad >= 0.5).all(), bad
    assert (model.scores(["the house over water", "", None, "ab", "tables and windows"]) < 0.5).all()


def test_words():
    assert tokens("You I.D.I.O.T, a b c d!") == ["you", "idiot", "abcd"]
    assert max(map(len, tox.pieces("x" * 100))) <= tox.PIECE + 2 and tox.pieces("ab") == []


def test_odd_rows_and_missing_labels(odd, none, spark, make):
    docs, labels = corpus(make, spark, 80)
    found = score_texts(odd.select("doc_id", "text", "kind"), docs, labels).collect()
    assert len(found) == odd.count() and all(0 <= r.score <= 1 for r in found)
    least = min(r.score for r in found)
    assert {r.score for r in found if r.doc_id in (1, 2, 5)} == {least}
    nobody = spark.createDataFrame([(None, None, None), (1, 0, None)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in score_texts(odd, odd, nobody).collect()} == {0}
    assert score_texts(none.select("doc_id", "text"), docs, labels).isEmpty()
    assert Model().scores(["text"])[0] < 0.5
