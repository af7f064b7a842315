"""Toxicity by a support vector machine over a gapped subsequence kernel with Nyström landmarks."""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Collection

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import held_out, on_workers, per_text, ship, table

ship(sys.modules[__name__])

#: Documents of each label the model is fitted on, on average; a bound on what is fitted, not on what is scored.
SAMPLE = {1: 1000, 0: 2000}
#: Subsequences are three characters within a stretch of SPAN, each skipped character costing a factor DECAY.
SPAN = 6
DECAY = 0.6
#: Longer tokens are read in overlapping pieces.
PIECE = 32
#: Landmarks, the more so from words typical of toxic documents; negative words per round of fitting.
LANDMARKS = 256
NEGATIVES = 6_000
ROUNDS = 4
RIDGE = 1e-4
#: Weight of all negatives against all positives, and the log odds that make a word suspect.
CLEAN = 3.0
TYPICAL = 1.5
#: Scores of words kept between batches of a task.
CACHE = 150_000
#: Least decision value a text can have, that of a text without any word of three characters.
FLOOR = -3.0

SIGNS = re.compile(r"[^\w\s]+|_+")
SENTENCE = re.compile(r"[.!?]+\s|\n")
SPELLED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")

#: Class of a character, 64 in all: letters a-z, digits, the edges of words, and all others folded into the rest; 0 is none.
CLASS = (37 + np.arange(65536, dtype=np.int64) * 40503 % 65536 % 25).astype(np.int32)
CLASS[ord("a"):ord("z") + 1] = np.arange(1, 27)
CLASS[ord("0"):ord("9") + 1] = np.arange(27, 37)
CLASS[ord("^")], CLASS[ord("$")] = 62, 63


def tokens(text: str) -> list[str]:
    """Lower-case words without signs; letters spelled one by one make one word."""
    plain = SIGNS.sub("", text.lower())
    return SPELLED.sub(lambda m: "".join(m[0].split()), plain).split()


def pieces(token: str) -> list[str]:
    """The word between marks for its edges, long ones in overlapping parts; nothing for words under three characters."""
    if len(token) <= PIECE:
        return [f"^{token}$"] if len(token) > 2 else []
    return [f"^{token[i:i + PIECE]}$" for i in range(0, len(token) - PIECE // 2, PIECE // 2)]


def _triples(length: int) -> tuple[np.ndarray, ...]:
    """Indices of the subsequences of a word, and the number of characters skipped in each."""
    found = [(i, j, k) for i in range(length) for k in range(i + 2, min(length, i + SPAN)) for j in range(i + 1, k)]
    first, second, third = np.array(found, dtype=np.int64).reshape(-1, 3).T
    return first, second, third, (third - first - 2).astype(np.int32)


def subsequences(words: list[str]):
    """Yields (places in ``words``, codes, weights, starts): the kernel's features of words of one length.

    ``codes`` and ``weights`` hold the distinct subsequences and their summed weights,
    word after word, ``starts`` where each word begins.  Words have three characters or more.
    """
    lengths = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    classes = CLASS[points % 65536]
    offsets = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        first, second, third, skipped = _triples(int(length))
        places = np.flatnonzero(lengths == length)
        step = max(1, 1_500_000 // len(first))
        for part in range(0, len(places), step):
            at = places[part:part + step]
            chars = classes[offsets[at][:, None] + np.arange(length)]
            keys = ((chars[:, first] << 12 | chars[:, second] << 6 | chars[:, third]) << 3) | skipped
            keys.sort(axis=1)
            codes = keys >> 3
            new = np.ones(codes.shape, dtype=bool)
            new[:, 1:] = codes[:, 1:] != codes[:, :-1]
            heads = np.flatnonzero(new)
            weights = np.add.reduceat((DECAY ** np.arange(8))[keys.ravel() & 7], heads)
            count = new.sum(axis=1)
            yield at, codes.ravel()[heads], weights, np.cumsum(count) - count


class Model:
    """Decision values of words, by one weight per subsequence, and their calibration to scores of texts."""

    def __init__(self) -> None:
        self.weights = np.zeros(1 << 18)
        self.bias, self.slope, self.shift = FLOOR, 1.0, 0.0
        self.cache: dict[str, float] = {}

    def __getstate__(self) -> dict:
        return {**self.__dict__, "cache": {}}

    def decide(self, words: list[str]) -> np.ndarray:
        """The machine's decision value of each word: its kernel with the landmarks, times their coefficients."""
        out = np.empty(len(words))
        for at, codes, weights, starts in subsequences(words):
            norm = np.sqrt(np.add.reduceat(weights * weights, starts))
            out[at] = np.add.reduceat(self.weights[codes] * weights, starts) / norm + self.bias
        return out

    def worst(self, bags: list[set[str]]) -> np.ndarray:
        """The greatest decision value of the words of each bag."""
        # Words are kept with their values until there are too many; a batch's own words are always at hand.
        new = list({w for bag in bags for w in bag if w not in self.cache})
        if len(self.cache) + len(new) > CACHE:
            self.cache = {}
            new = list({w for bag in bags for w in bag})
        parts = [pieces(w) for w in new]
        flat = [p for ps in parts for p in ps]
        values = iter(np.maximum(self.decide(flat), FLOOR).tolist()) if flat else iter(())
        for word, ps in zip(new, parts, strict=True):
            self.cache[word] = max((next(values) for _ in ps), default=FLOOR)
        found = self.cache
        return np.array([max((found[w] for w in bag), default=FLOOR) for bag in bags])

    def scores(self, texts: list[str | None]) -> np.ndarray:
        value = self.worst([set(tokens(t or "")) for t in texts])
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -50, 50)))


def kernel_rows(words: list[str], codes: np.ndarray, marks: np.ndarray) -> np.ndarray:
    """Normalised kernel of words with landmarks, whose features over ``codes`` are the columns of ``marks``."""
    out = np.empty((len(words), marks.shape[1]))
    for at, found, weights, starts in subsequences(words):
        norm = np.sqrt(np.add.reduceat(weights * weights, starts))
        spot = np.minimum(np.searchsorted(codes, found), len(codes) - 1)
        weights = np.where(codes[spot] == found, weights, 0.0)
        ends = [*starts[1:], len(found)]
        for i, (a, b) in enumerate(zip(starts, ends, strict=True)):
            out[at[i]] = weights[a:b] @ marks[spot[a:b]] / norm[i]
    return out


def landmark_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted codes of all subsequences of the landmarks, and their normalised features (codes by landmarks)."""
    parts = list(subsequences(words))
    codes = np.unique(np.concatenate([p[1] for p in parts]))
    marks = np.zeros((len(codes), len(words)))
    for at, found, weights, starts in parts:
        norm = np.sqrt(np.add.reduceat(weights * weights, starts))
        owner = np.repeat(np.arange(len(at)), np.diff([*starts, len(found)]))
        marks[np.searchsorted(codes, found), at[owner]] = weights / norm[owner]
    return codes, marks


def squared_hinge(rows: np.ndarray, labels: np.ndarray, costs: np.ndarray, ridge: float) -> np.ndarray:
    """Weights (the last one the bias) of a linear machine with squared hinge loss, by Newton's method."""
    rows = np.hstack([rows, np.ones((len(rows), 1))])
    penalty = np.full(rows.shape[1], ridge)
    penalty[-1] = ridge / 100
    weights = np.zeros(rows.shape[1])
    active = np.ones(len(rows), dtype=bool)
    for _ in range(30):
        held = rows[active] * costs[active, None]
        weights = np.linalg.solve(held.T @ rows[active] + np.diag(penalty), held.T @ labels[active])
        now = labels * (rows @ weights) < 1
        if (now == active).all():
            break
        active = now
    return weights


def calibrate(values: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through (decision value, label), labels weighing the same in total."""
    rows = np.stack([values, np.ones_like(values)], axis=1)
    costs = np.where(labels == 1, 0.5 / max(1, (labels == 1).sum()), 0.5 / max(1, (labels == 0).sum())) * len(labels)
    theta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ theta, -30, 30)))
        gradient = rows.T @ (costs * (p - labels)) + 1e-2 * theta
        theta = theta - np.linalg.solve((rows * (costs * p * (1 - p))[:, None]).T @ rows + 1e-2 * np.eye(2), gradient)
        theta = np.clip(theta, -20, 20)
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit(sentences: list[tuple[int, list[Collection[str]]]]) -> Model:
    """Fit on (label, words of each sentence) of documents.

    All sentences of clean documents are negative.  Of a toxic document the sentence
    with the worst word is positive: first the suspect word most typical of toxic documents, in
    later rounds the one the machine itself thinks worst.  A sentence's value is that of
    its worst word, so negatives are the words of clean documents, the frequent
    ones first and then those with the greatest values.
    """
    model = Model()
    shared: dict[str, list[str]] = {}  # one string for all places where a word occurs
    for w in {w for _, parts in sentences for part in parts for w in part}:
        shared[w] = pieces(w)
    bags = [(label, sorted({p for part in parts for w in part for p in shared[w]})) for label, parts in sentences]
    del shared
    toxic, clean = [b for y, b in bags if y == 1 and b], [b for y, b in bags if y == 0 and b]
    if not toxic or not clean:
        return model
    bad, good = Counter(w for b in toxic for w in b), Counter(w for b in clean for w in b)
    odds = {w: np.log((n + 0.5) / (len(toxic) + 1)) - np.log((good[w] + 0.5) / (len(clean) + 1)) for w, n in bad.items()}
    # Words about as usual in clean documents can't be what makes a document toxic.
    suspect = {w for w in bad if odds[w] >= TYPICAL}
    toxic = [s for s in ([w for w in b if w in suspect] for b in toxic) if s]
    if not toxic:
        return model
    typical = sorted(suspect, key=lambda w: (-odds[w], w))
    frequent = sorted(good, key=lambda w: (-good[w], w))
    chosen = list(dict.fromkeys([*typical[:LANDMARKS * 3 // 4], *frequent[:LANDMARKS // 4]]))
    codes, marks = landmark_features(chosen)
    values, vectors = np.linalg.eigh(marks.T @ marks)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T

    witness = [max(b, key=lambda w: (odds[w], w)) for b in toxic]
    negative = frequent[:NEGATIVES]
    spare = sorted(good)
    known: dict[str, np.ndarray] = {}
    for _ in range(ROUNDS):
        seen = sorted(set(witness))
        new = [w for w in dict.fromkeys([*seen, *negative]) if w not in known]
        known.update(zip(new, kernel_rows(new, codes, marks) @ root, strict=True))
        rows = np.array([known[w] for w in [*seen, *negative]])
        labels = np.r_[np.ones(len(seen)), -np.ones(len(negative))]
        count = Counter(witness)
        costs = np.r_[np.array([count[w] for w in seen]) / len(witness), np.full(len(negative), CLEAN / len(negative))]
        weights = squared_hinge(rows, labels, costs, RIDGE)
        model.weights = np.zeros(1 << 18)
        model.weights[codes] = marks @ (root @ weights[:-1])
        model.bias, model.cache = float(weights[-1]), {}
        judged = model.decide(spare)
        hard = [spare[i] for i in np.argsort(-judged, kind="stable")[:NEGATIVES // 4]]
        negative = list(dict.fromkeys([*negative, *hard]))
        judged = sorted(suspect)
        value = dict(zip(judged, model.decide(judged), strict=True))
        witness = [max(b, key=lambda w: (value[w], w)) for b in toxic]
    worst = np.concatenate([model.worst([set().union(*parts) for _, parts in sentences[i:i + 200]]) for i in range(0, len(sentences), 200)])
    model.slope, model.shift = calibrate(worst, np.array([float(y) for y, _ in bags]))
    return model


def sample_sentences(docs: DataFrame, labels: DataFrame) -> list[tuple[int, list[Collection[str]]]]:
    """(label, words of each sentence) of about SAMPLE labelled documents that are not held out, chosen by a hash of the id."""
    usable = labels.filter(~held_out() & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return []
    rate = F.when(F.col("toxic") == 1, SAMPLE[1] / sizes[1]).otherwise(SAMPLE[0] / sizes[0])
    draw = F.pmod(F.xxhash64(F.lit("toxicity"), "doc_id"), F.lit(1 << 30)).cast("double") / float(1 << 30)
    chosen = usable.filter(draw < rate)

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(["\n".join(" ".join(sorted(set(tokens(s)))) for s in SENTENCE.split(t or "")) for t in texts.to_pylist()], pa.string())]

    # The sample's size is bounded by SAMPLE, and so is what is broadcast and what comes back.
    rows = per_text(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"), "words string", run)
    found = sorted((r["doc_id"], r["words"], r["toxic"]) for r in rows.collect())
    return [(label, [tuple(map(sys.intern, s.split(" "))) for s in words.split("\n") if s]) for _, words, label in found]


def score_texts(docs: DataFrame, train: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without its text, with ``score`` (0 to 1, higher: toxic likelier) and ``predicted``.

    The model is fitted on ``train`` and its ``labels`` (doc_id, toxic), leaving out held-out
    ids.  Every word of a text is compared with the landmarks by the subsequences of
    three characters they share, with gaps, so a word with characters put in or
    another ending still resembles its base; signs inside words are dropped and letters spelled singly
    are joined.  The worst word decides a text's score.

    Null and empty texts, and texts without a word of three characters, get the least score.
    Without labels of both kinds all scores are that.  Repeated rows get equal results;
    other columns pass through; no rows give no rows.
    """
    model = on_workers(docs.sparkSession, fit(sample_sentences(train, labels)))

    def run(texts: pa.Array) -> list[pa.Array]:
        scores = model().scores(texts.to_pylist())
        return [pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))]

    return per_text(docs, "score double, predicted int", run)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_texts(docs.select("doc_id", "text"), docs, table(spark, sf_dir, "labels")).select(
        "doc_id", held_out().alias("held_out"), "score", "predicted")
