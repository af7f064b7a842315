from __future__ import annotations

import math
import random
import zlib
from collections import Counter

from tillmark.llm.langid import LONGEST, Model, identify, keep_identified

WORDS = {"en": "the house and garden with green trees", "de": "das haus und der garten mit bäumen", "es": "la casa y el jardín con árboles"}


def corpus(make):
    return make([(i, " ".join(WORDS[lang].split()[(i + k) % 6] for k in range(5)), lang, None)
                 for i in range(300) for lang in [list(WORDS)[i % 3]]])


def test_held_out_rows_are_told_apart(make):
    docs = corpus(make)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    for r in identify(docs.select("doc_id", "text", "source"), docs).collect():
        if zlib.crc32(str(r.doc_id).encode()) % 5 == 0:
            assert r.lang_pred == truth[r.doc_id] and 0.5 < r.score <= 1


def test_held_out_labels_do_not_matter(make, rows):
    docs = corpus(make).collect()
    other = make([(r.doc_id, r.text, "xx" if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 else r.lang, None) for r in docs])
    same = make([(r.doc_id, r.text, r.lang, None) for r in docs])
    assert rows(identify(other.drop("score")), "doc_id", "lang_pred", "score") == rows(identify(same.drop("score")), "doc_id", "lang_pred", "score")


def test_unseen_words_fall_back_to_shorter_grams():
    model = Model([("en", "house", 5), ("de", "haus", 5), ("de", "äu", 3)])
    assert model.predict("housing")[0] == "en" and model.predict("hausen")[0] == "de"
    assert model.predict("ä")[0] == "de" and (model.word("qqqq") == 0).all()
    assert max(map(len, model.rows[LONGEST])) == LONGEST


def plain_scores(train, text):
    """Language and share of the likelihood, from the counts by the definition: words seen twice, else the longest seen n-grams."""
    langs = sorted({lang for lang, _ in train})
    words = {lang: Counter(w for at, t in train if at == lang for w in t.lower().split()) for lang in langs}
    tables = [words]
    for order in range(1, LONGEST + 1):
        found = {lang: Counter() for lang in langs}
        for lang in langs:
            for word, n in words[lang].items():
                framed = f"<{word}>" if order > 1 else word
                for i in range(len(framed) - order + 1):
                    found[lang][framed[i:i + order]] += 1 + math.log(n)
        tables.append(found)
    keys = [{k for lang in langs for k in t[lang] if order or sum(t[x][k] for x in langs) >= 2} for order, t in enumerate(tables)]
    log = lambda order, key, lang: math.log(tables[order][lang][key] + 0.5) - math.log(
        sum(tables[order][lang][k] for k in keys[order]) + 0.5 * len(keys[order]))

    def word_log(word, lang):
        if word in keys[0]:
            return log(0, word, lang)
        for order in range(LONGEST, 0, -1):
            framed = f"<{word}>" if order > 1 else word
            seen = [g for g in (framed[i:i + order] for i in range(len(framed) - order + 1)) if g in keys[order]]
            if seen:
                return sum(log(order, g, lang) for g in seen) / len(seen)
        return 0.0

    total = {lang: sum(word_log(w, lang) for w in text.lower().split()) for lang in langs}
    best = max(langs, key=lambda lang: total[lang])
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def test_scores_equal_the_definition_for_all_texts(make):
    """A sample that takes every labelled row; texts with known words, words seen once, unseen words and unseen letters."""
    rng = random.Random(6)
    stems = {lang: WORDS[lang].split() for lang in WORDS}
    texts = [(i, lang, " ".join(rng.choice(stems[lang]) + rng.choice(["", "", "", "en", "s", "x", "qu"]) for _ in range(rng.randint(1, 12))))
             for i in range(120) for lang in [rng.choice(list(WORDS))]]
    docs = make([(i, t, lang, None) for i, lang, t in texts])
    train = [(lang, t) for i, lang, t in texts if zlib.crc32(str(i).encode()) % 5]
    for r in identify(docs.select("doc_id", "text"), docs, sample=10_000).collect():
        lang, score = plain_scores(train, texts[r.doc_id][2])
        assert r.lang_pred == lang and math.isclose(r.score, score, rel_tol=1e-4)


def test_ties_go_to_the_first_language():
    model = Model([("b", "word", 2), ("a", "word", 2)])
    assert model.predict("word") == ("a", 0.5) and model.predict("zzz") == ("a", 0.5)


def test_odd_rows(odd, none):
    found = {(r.doc_id, r.text is None): r for r in identify(odd.withColumnRenamed("text", "was").selectExpr("*", "was as text"), odd)
             .selectExpr("doc_id", "lang_pred", "score", "was as text").collect()}
    for key in ((1, False), (2, True), (5, False), (9, False)):
        assert (found[key].lang_pred, found[key].score) == ("und", 0.0)
    assert {r.lang_pred for r in found.values()} <= {"en", "de", "und"}
    assert identify(none).isEmpty() and keep_identified(none).isEmpty()
    # Without labels there is nothing to tell apart.
    assert {r.lang_pred for r in identify(odd, none).collect()} == {"und"}


def test_rejected_rows_go_and_others_keep_their_columns(odd):
    kept = keep_identified(odd)
    assert kept.columns == odd.columns
    assert {1, 2, 5, 9}.isdisjoint(r.doc_id for r in kept.collect()) and kept.filter("doc_id in (6, 7)").count() == 2


def test_without_a_learned_language_all_texts_with_a_letter_stay(make):
    unlabelled = make([(1, "some words", None, "a"), (2, "12 34", None, "a"), (3, None, None, "a"), (4, "漢字", None, "a")])
    kept = keep_identified(unlabelled)
    assert kept.columns == unlabelled.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4]
