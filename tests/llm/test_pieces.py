from __future__ import annotations

import os
import random

import numpy as np
import pytest
import sentencepiece

from tillmark.llm import pieces
from tillmark.llm.pieces import MODEL_FILE, SPACE, Chunk, Encoder, composed, decode, encode, encode_decode, resolved, words

pytestmark = pytest.mark.skipif(not os.path.isfile(MODEL_FILE), reason="no vocabulary")
PARTS = ["a", "b", " ", "-", "=", "the", "ing", "é", "漢", "😀", "\n", "  ", "1", "<0x0A>", "International", "aaaa", SPACE]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL_FILE)


@pytest.fixture(scope="module")
def encoder():
    with open(MODEL_FILE, "rb") as file:
        return Encoder(file.read())


def by_chunks(encoder, text, size):
    full = SPACE + text.replace(" ", SPACE)
    bodies = [full[i:i + size] for i in range(0, len(full), size)]
    chunks = [Chunk(bodies[i - 1][-15:] if i else "", b, bodies[i + 1][:15] if i + 1 < len(bodies) else "", i == 0, i == len(bodies) - 1)
              for i, b in enumerate(bodies)]
    number = lambda s: s[0] << 8 | s[1]
    matrices = [[(number(a), number(b)) for a, b in encoder.transfer(c)] for c in chunks]
    cut = len(matrices) // 2
    if cut:  # the product does not depend on where it is bracketed
        assert composed([composed(matrices[:cut]), composed(matrices[cut:])]) == composed(matrices)
    assert composed(matrices) == [(0, 0)]
    return [i for c, (a, b) in zip(chunks, resolved(matrices, 0, 0), strict=True)
            for i in np.frombuffer(encoder.chunk(c, (a >> 8, a & 255), (b >> 8, b & 255)), "<i4").tolist()]


def test_chunks_give_the_ids_of_the_whole_text(encoder, library):
    random.seed(3)
    for _ in range(150):
        text = "".join(random.choice(PARTS) for _ in range(random.randint(1, 100)))
        assert by_chunks(encoder, text, random.choice([16, 17, 23, 40])) == library.encode(text)


def test_words_cut_a_text_without_loss():
    random.seed(4)
    for _ in range(2000):
        text = "".join(random.choice(["a", SPACE, "b"]) for _ in range(random.randint(0, 9)))
        cut = words(text)
        assert "".join(cut) == text and all(w and SPACE not in w.lstrip(SPACE) for w in cut)


@pytest.mark.parametrize("chunk, fan", [(32_768, 64), (200, 2), (1000, 3)])
def test_tables_equal_the_library_and_come_back(odd, library, chunk, fan):
    texts = {}
    for r in odd.collect():
        texts.setdefault(r.doc_id, set()).add(r.text or "")
    found = decode(encode(odd, chunk=chunk, fan=fan)).collect()
    assert len(found) == odd.count() and found[0].kind == "x"
    for r in found:
        assert r.text in texts[r.doc_id] and r.ids == library.encode(r.text)


def test_one_pass_gives_the_rows_of_two(odd):
    both, two = encode_decode(odd), decode(encode(odd))
    assert both.schema.names == two.schema.names and sorted(map(str, both.collect())) == sorted(map(str, two.collect()))


def test_a_task_of_the_pipeline_has_one_python_worker_for_both(odd, spark, capsys):
    import corpus_pipeline
    corpus_pipeline.tokens(spark, odd.filter("length(text) < 100"), "").explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1


def test_steps_are_not_kept_without_end(encoder, library, monkeypatch):
    monkeypatch.setattr(pieces, "CACHE", 50)
    text = "".join(random.Random(5).choice("abcdefgh漢字") for _ in range(400))
    assert by_chunks(encoder, text, 40) == library.encode(text)
    encoder.transfer(Chunk("", SPACE + "a", "", True, True))
    assert len(encoder.steps) <= 50


def test_no_rows_and_no_ids(none, spark):
    assert encode(none).isEmpty()
    empty = decode(spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>"))
    assert [r.text for r in empty.collect()] == ["", ""]


def test_words_without_spaces_may_be_longer_than_chunks(make, library):
    text = "漢字" * 300 + "x" * 500 + " " * 300 + "=" * 333
    [row] = decode(encode(make([(1, text, None, None)]), chunk=64, fan=4)).collect()
    assert row.ids == library.encode(text) and row.text == text
