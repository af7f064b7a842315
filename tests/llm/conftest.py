from __future__ import annotations

import pytest

#: Names the operators use themselves, which a table may have as well.
CLASHING = ["kind", "name", "size", "bits", "key", "row", "score", "_row", "_key", "ids", "host", "spans", "sha", "part", "copies", "root"]
DDL = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
LONG = " ".join(f"word{i % 977} number{i % 31}" for i in range(30_000))


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text, lang, source), with extra columns of clashing names."""
    def build(rows):
        return spark.createDataFrame(
            [(i, t, lang, s, len(t or ""), *("x" for _ in CLASHING)) for i, t, lang, s in rows], DDL)
    return build


@pytest.fixture(scope="session")
def odd(make):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    return make([
        (1, "", "en", "a"), (2, None, None, None), (None, "Some text without an id", "en", "b"),
        (3, "The same text here", "en", "a"), (3, "The same text here", "en", "a"), (4, "THE SAME text here", None, "b"),
        (5, " \t\n", "en", None), (6, LONG, "en", "a"), (7, LONG + " end", "en", "c"), (8, "Ünïcode 漢字 😀 text", "de", "c"),
        (9, "12 34 !?", "en", "a")]).persist()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)
