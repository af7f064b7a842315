from __future__ import annotations

import itertools
import random
import re

import numpy as np
import pytest

from pii_held_out import HELD_OUT

from tillmark.llm.pii import EXAMPLES, KINDS, Model, Shapes, base_spans, detect, find, labelled, luhn, marks

RULES = [re.compile(p, re.ASCII) for p in (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain(text):
    out = []
    for kind, rule in enumerate(RULES):
        for m in rule.finditer(text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if ((kind == 1 and any(int(p) > 255 for p in m[0].split("."))) or (kind == 2 and not (14 <= len(digits) <= 19 and luhn(digits)))
                    or (kind == 3 and not 10 <= len(digits) <= 15)):
                continue
            out.append((m.start(), kind, m.end()))
    return sorted(out)


@pytest.fixture(scope="module")
def model():
    return Model()


def test_fixed_rules_equal_their_patterns():
    random.seed(1)
    for _ in range(20_000):
        text = "".join(random.choice("a@.1+ -(25é") for _ in range(random.randint(0, 40)))
        assert base_spans(text) == plain(text)


def test_long_runs_cost_no_more_than_their_length():
    for run in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+" * 300_000, "a@" * 100_000):
        base_spans(run)


def test_the_table_is_learned(model):
    for line in filter(None, EXAMPLES.split("\n")):
        text, tags = labelled(line)
        assert model.decode(Shapes([text], model.classes, model.cues)).tolist() == tags


def test_decoding_equals_trying_all_tags(model):
    texts = ["Call 499-555-6503 x", "bob(at)mail.com 10.0.0.1:80", "4111.1111.1111.1111 and (212) 555-0147", "no"]
    shapes = Shapes(texts, model.classes, model.cues)
    emit = model.sets[shapes.patterns] + sum(model.weights[c] for c in shapes.ids.T)
    want = []
    for text in range(len(texts)):
        at = np.flatnonzero(shapes.owner == text)
        want += max(itertools.product(range(emit.shape[1]), repeat=len(at)), key=lambda z: sum(
            emit[i, t] for i, t in zip(at, z, strict=True)) + sum(model.moves[a, b] for a, b in itertools.pairwise(z)))
    assert model.decode(shapes).tolist() == want


def test_skipped_stretches_change_nothing(model):
    random.seed(2)
    words = [w for line in EXAMPLES.split("\n") for w in labelled(line)[0].split()]
    texts = [" ".join(random.choices(words, k=random.randint(0, 60))) for _ in range(300)]
    shapes = Shapes(texts, model.classes, model.cues)
    emit = model.sets[shapes.patterns] + sum(model.weights[c] for c in shapes.ids.T)
    want = []
    for text in range(len(texts)):
        score, back = None, []
        for row in emit[shapes.owner == text]:
            reach = np.zeros((1, len(row))) if score is None else score[:, None] + model.moves
            back.append(reach.argmax(axis=0))
            score = row + reach.max(axis=0)
        tags = [] if score is None else [int(score.argmax())]
        for step in reversed(back[1:]):
            tags.append(int(step[tags[-1]]))
        want += tags[::-1]
    assert model.decode(shapes).tolist() == want and len(set(want)) > 6


def test_lines_never_fitted_on(model):
    assert not {*HELD_OUT.split("\n")} & {*EXAMPLES.split("\n")} - {""}
    meet = lambda x, ys: any(x[1] == y[1] and x[0] < y[2] and y[0] < x[2] for y in ys)
    for kind, name in enumerate(KINDS):
        wanted, caught, shown, right = 0, 0, 0, 0
        for line in filter(None, HELD_OUT.split("\n")):
            want = [s for s in marks(line) if s[1] == kind]
            got = [s for s in next(find(model, [labelled(line)[0]]))[1] if s[1] == kind]
            wanted, caught = wanted + len(want), caught + sum(meet(s, got) for s in want)
            shown, right = shown + len(got), right + sum(meet(s, want) for s in got)
        assert caught >= 0.9 * wanted > 0 and right >= 0.9 * shown, (name, wanted, caught, shown, right)


def test_texts_side_by_side_do_not_influence_each_other(model):
    texts = ["Call 499-555-6503 x", "", "12", "  ", "555 0147", "é 漢 bob(at)mail.com"]
    assert model.spans(texts) == [model.spans([t])[0] for t in texts]


def test_loose_forms_are_added_and_clean_texts_left_alone(model):
    shown = {"call (499) 555-6503 now": "(499) 555-6503", "mail bob(at)mail.com": "bob(at)mail.com", "card 4111.1111.1111.1111 ok": "4111.1111.1111.1111"}
    for text, part in shown.items():
        [(base, spans)] = find(model, [text])
        assert base == [] and [text[a:b] for a, _, b in spans] == [part]
    more = {"ask jane at example dot com now": "jane at example dot com", "mail john [at] mail [dot] org": "john [at] mail [dot] org",
            "host 2001:db8::7 is up": "2001:db8::7"}
    for text, part in more.items():
        assert [text[a:b] for a, _, b in next(find(model, [text]))[1]] == [part]
    for text in ("SSN 123-45-6789", "part no. 212-555-0147", "look at example.com at noon", "std::vector and abc::def",
                 "In 1984 there were 30 000 of 1,250.00", "Version 2.0, January 2004", "1.2. 3.4. 5.6.7 and 12:30", "a*** b%%% 7###"):
        assert next(find(model, [text])) == ([], [])


def test_odd_rows(odd, none):
    found = detect(odd).collect()
    assert len(found) == odd.count()
    texts = sorted((r.doc_id or 0, [tuple(s) for s in r.base]) for r in found)
    want = sorted((r.doc_id or 0, [(KINDS[k], a, b) for a, k, b in plain(r.text)]) for r in odd.collect())
    assert texts == want and found[0].kind == "x"
    assert detect(none).isEmpty()


def test_places_are_code_points(make):
    r = detect(make([(1, "漢😀é joe@mail.example.com +1 (212) 555-0199", None, None)])).first()
    assert [tuple(s) for s in r.base] == [("email", 4, 24), ("phone", 25, 42)] and r.spans == r.base
