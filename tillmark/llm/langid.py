"""Language identification by known words first, then by ever shorter character n-grams."""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import held_out, in_small_batches, on_workers, per_text, ship, sliced, table

ship(sys.modules[__name__])

UNKNOWN = "und"
#: Labelled documents a language is learned from, on average; a bound on what is fitted, not on what is predicted.
SAMPLE = 1000
#: Characters of the longest n-gram for words that were not seen.
LONGEST = 4
#: A word counts as known if the sample has it this often.
KNOWN = 2
#: Added to every count.
SMOOTH = 0.5
#: Runs of letters (and of the rare number signs that are no digits); digits, underscores and other signs separate them.
LETTERS = re.compile(r"[^\W\d_]+")
#: Words kept between batches of a task.
CACHE = 50_000


def sample_words(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str, int]]:
    """(lang, word, count) over about ``sample`` labelled documents of each language, chosen by a hash of the id.

    The words are counted in Spark; their number is bounded by the sample.
    """
    labelled = docs.filter(~held_out() & F.col("lang").isNotNull())
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    rates = {r["lang"]: sample / r["n"] for r in sizes.collect()}  # one row per language
    if not rates:
        return []
    rate = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])[F.col("lang")]
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))
    counted = labelled.filter(draw < rate).select("lang", F.explode(words).alias("word")).groupBy("lang", "word").count()
    return [tuple(r) for r in counted.orderBy("lang", "word").collect()]


class Model:
    """Log frequencies per language of words and of n-grams of every order.

    ``rows`` maps a word or n-gram to its row in ``logs``, which has a column per language.
    """

    def __init__(self, counted: list[tuple[str, str, int]]) -> None:
        self.langs = sorted({lang for lang, _, _ in counted})
        column = {lang: i for i, lang in enumerate(self.langs)}
        counts: list[list[Counter]] = [[Counter() for _ in self.langs] for _ in range(LONGEST + 1)]  # by order, 0 for words
        for lang, word, count in counted:
            at = column[lang]
            counts[0][at][word] += count
            for order in range(1, LONGEST + 1):
                # Each different word counts for its n-grams as often as it occurs, dampened: unseen words resemble rare ones.
                for gram in ngrams(word, order):
                    counts[order][at][gram] += 1 + math.log(count)
        self.rows: list[dict[str, int]] = []
        self.logs: list[np.ndarray] = []
        for order, by_lang in enumerate(counts):
            total = sum(by_lang, Counter())
            keys = sorted(k for k, n in total.items() if order or n >= KNOWN)
            matrix = np.array([[c[k] for c in by_lang] for k in keys], dtype=np.float32).reshape(len(keys), len(self.langs))
            self.rows.append({k: i for i, k in enumerate(keys)})
            self.logs.append(np.log(matrix + SMOOTH) - np.log(matrix.sum(axis=0) + SMOOTH * max(1, len(keys))))
        self.cache: dict[str, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "cache": {}}

    def word(self, word: str) -> np.ndarray:
        """Log likelihood of a word in each language, 0 if nothing in it was ever seen."""
        found = self.cache.get(word)
        if found is None:
            known = self.rows[0].get(word)
            found = None if known is None else self.logs[0][known]
            order = LONGEST
            while found is None and order:
                rows = [self.rows[order][g] for g in ngrams(word, order) if g in self.rows[order]]
                found = self.logs[order][rows].mean(axis=0) if rows else None
                order -= 1
            found = np.zeros(len(self.langs)) if found is None else found
            if len(self.cache) >= CACHE:
                self.cache.clear()
            self.cache[word] = found
        return found

    def predict(self, text: str | None) -> tuple[str, float]:
        """The likeliest language (the first one of equals) and its share of the likelihood."""
        words = LETTERS.findall((text or "").lower())
        if not self.langs or not any(c.isalpha() for w in words for c in w):
            return UNKNOWN, 0.0
        counts = Counter(words)
        total = np.fromiter(counts.values(), float, len(counts)) @ np.array([self.word(w) for w in counts])
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def ngrams(word: str, order: int) -> list[str]:
    """The n-grams of a word between its edges; a word shorter than that has none."""
    framed = f"<{word}>" if order > 1 else word
    return [framed[i:i + order] for i in range(len(framed) - order + 1)]


def fitted(docs: DataFrame, sample: int = SAMPLE) -> Callable[[], Model]:
    return on_workers(docs.sparkSession, Model(sample_words(docs.select("doc_id", "text", "lang"), sample)))


def identify(docs: DataFrame, train: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without its text, with ``lang_pred`` and ``score`` (0 to 1).

    The model is learned from ``train`` (else ``docs``): rows with a language whose id's
    crc32 modulo 5 is not 0.  A text is scored over all its words: a known word by its
    log frequency in each language, any other by the mean over its n-grams of the
    longest order of which some were seen.  The score is the language's share of the
    likelihood over all learned languages.

    Null texts and texts without a letter get ``und`` with score 0, as does everything if
    there are no labelled rows.  Ties go to the language first in code-point order;
    repeated rows get equal results; other columns pass through.
    """
    model = fitted(docs if train is None else train, sample)

    def run(texts: pa.Array) -> list[pa.Array]:
        found = [model().predict(t) for t in texts.to_pylist()]
        return [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())]

    return per_text(docs, "lang_pred string, score double", run)


def keep_identified(docs: DataFrame, least: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose language is identified with a score of at least ``least``, with all their columns.

    If no language can be learned, as no row outside the held-out fold has one, all texts with a letter stay.
    """
    in_small_batches(docs.sparkSession)
    model = fitted(docs, sample)

    def stays(text: str | None) -> bool:
        if not model().langs:
            return any(c.isalpha() for c in text or "")
        lang, score = model().predict(text)
        return lang != UNKNOWN and score >= least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            yield batch.filter(pa.array([stays(t) for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), docs).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")
