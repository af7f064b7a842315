"""Personal data: fixed rules, and a conditional random field over word shapes for what is written otherwise."""

from __future__ import annotations

import ipaddress
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import joined, on_workers, per_text, ship, table
from tillmark.llm.pii_table import EXAMPLES

ship(sys.modules[__name__])

KINDS = ("email", "ip", "card", "phone")
#: Tag 0 is none; kind k begins with tag 2k+1 and goes on with 2k+2.
TAGS = 2 * len(KINDS) + 1

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NUMBERS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
#: Characters of texts that are read side by side; a longer text is read by itself.
PART = 500_000
#: Penalty on the weights of moves; the shapes are to decide, so that most words are certain by themselves.
MOVE_RIDGE = 1.0

WORDS = re.compile(r"\S+")

Span = tuple[int, int, int]


# ---- fixed rules -----------------------------------------------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and dotted domain, found from the @ so that long words cost no more."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Of a chain of dotted numbers, every four in turn; those with a part above 255 are dropped."""
    for chain in NUMBERS.finditer(text):
        parts, start = chain[0].split("."), chain.start()
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            stop = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in four):
                yield start, stop
            start = stop + 1


def cards(text: str) -> Iterator[tuple[int, int]]:
    for found in CARD.finditer(text):
        digits = found[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" in text:
        for found in PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in found[0]) <= 15:
                yield found.span()


def base_spans(text: str) -> list[Span]:
    """(start, kind, stop) by the fixed rules, in order of start, then kind."""
    return sorted((a, k, b) for k, rule in enumerate((emails, addresses, cards, phones)) for a, b in rule(text))


# ---- word shapes -----------------------------------------------------------------------------------------------------

#: Classes of characters: 0 white space, 1 lower, 2 upper, 3 digit, then one for each sign below, 14 other signs, 15 other letters.
SIGNS = "@.-+()[]:,"
OTHER, LETTER = 14, 15
CUES = ("phone", "tel", "telephone", "call", "mobile", "fax", "number", "ring", "email", "mail", "address", "write", "card",
        "charge", "pay", "ip", "server", "ping", "connect", "version", "id", "order", "key", "token", "at", "dot", "no", "ssn", "part",
        "serial", "invoice", "case", "ref", "isbn", "account", "tracking", "item", "model", "ticket", "host", "router", "contact", "reach",
        "cell", "text", "dial", "visa", "mastercard", "amex", "credit", "debit")
DIGIT_STEPS = np.array([1, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 17, 20])
LENGTH_STEPS = np.array([2, 3, 5, 8, 11, 14, 18, 25, 40])


#: The bit of each class; white space has none.
BIT = np.array([0, *(1 << k for k in range(1, 16))], dtype=np.uint16)


def _classes() -> np.ndarray:
    kinds = np.full(65536, OTHER, dtype=np.uint8)
    for c in range(65536):
        s = chr(c)
        if s.isspace():
            kinds[c] = 0
        elif s.isalpha():
            kinds[c] = LETTER
    for first, last, kind in (("a", "z", 1), ("A", "Z", 2), ("0", "9", 3)):
        kinds[ord(first):ord(last) + 1] = kind
    for i, s in enumerate(SIGNS):
        kinds[ord(s)] = 4 + i
    return kinds


def _hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash of each word's letters, lower-case, whatever signs are around them."""
    letters = ((codes | 32) >= 97) & ((codes | 32) <= 122)
    count = np.cumsum(letters)
    places = np.maximum(count - 1 - np.repeat(count[starts] - letters[starts], np.diff([*starts, len(codes)])), 0)
    values = np.where(letters, (codes | 32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), np.uint64(0))
    # Multiplied by an odd number that depends on the place among the first 32 letters.
    return np.add.reduceat((values ^ (values >> np.uint64(29))) * (2 * np.minimum(places, 31).astype(np.uint64) + np.uint64(3)), starts)


class Shapes:
    """The words of some texts: where they start and stop in the joined texts, which start a text, and their features' ids."""

    #: Offsets of the feature groups: own classes (16), first (16), last (16), digits, length, cue, digits and cue
    #: of both neighbours, and the cue two words before.
    OWN, FIRST, LAST, DIGITS = 0, 16, 32, 48
    LENGTH = DIGITS + len(DIGIT_STEPS) + 1
    CUE = LENGTH + len(LENGTH_STEPS) + 1
    BEFORE = CUE + len(CUES) + 1
    BEFORE_CUE = BEFORE + len(DIGIT_STEPS) + 1
    AFTER = BEFORE_CUE + len(CUES) + 1
    AFTER_CUE = AFTER + len(DIGIT_STEPS) + 1
    SECOND_CUE = AFTER_CUE + len(CUES) + 1
    COUNT = SECOND_CUE + len(CUES) + 1

    def __init__(self, texts: list[str], classes: np.ndarray, cues: np.ndarray) -> None:
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        #: Where each text begins in the joined one.
        self.offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        kinds = classes[np.minimum(codes, 65535)]
        solid = np.concatenate([[False], kinds > 0, [False]])
        edges = np.flatnonzero(solid[1:] != solid[:-1])
        self.starts, self.stops = edges[::2], edges[1::2]
        if not len(self.starts):
            self.patterns, self.ids, self.heads = np.zeros(0, dtype=np.int64), np.zeros((0, 10), dtype=np.int64), np.zeros(0, dtype=bool)
            return
        self.owner = np.searchsorted(self.offsets, self.starts, side="right") - 1
        self.heads = np.concatenate([[True], self.owner[1:] != self.owner[:-1]])
        inner, codes = kinds[self.starts[0]:], codes[self.starts[0]:]
        starts = self.starts - self.starts[0]
        #: The classes that occur in a word, as bits.
        self.patterns = np.bitwise_or.reduceat(BIT[inner], starts).astype(np.int64)
        digits = np.searchsorted(DIGIT_STEPS, np.add.reduceat(inner == 3, starts, dtype=np.int64), side="right")
        hashed = _hashes(codes, starts)
        order = np.argsort(cues)
        spot = np.minimum(np.searchsorted(cues[order], hashed), len(cues) - 1)
        cue = np.where(cues[order][spot] == hashed, order[spot] + 1, 0)
        # Features of neighbours stop at the ends of a text.
        before = lambda values: np.where(self.heads, 0, np.concatenate([[0], values[:-1]]))
        tails = np.concatenate([self.heads[1:], [True]])
        after = lambda values: np.where(tails, 0, np.concatenate([values[1:], [0]]))
        self.ids = np.stack([
            self.FIRST + kinds[self.starts], self.LAST + kinds[self.stops - 1], self.DIGITS + digits,
            self.LENGTH + np.searchsorted(LENGTH_STEPS, self.stops - self.starts, side="right"), self.CUE + cue,
            self.BEFORE + before(digits), self.BEFORE_CUE + before(cue),
            self.AFTER + after(digits), self.AFTER_CUE + after(cue), self.SECOND_CUE + before(before(cue))], axis=1)


class Model:
    """A linear-chain conditional random field: a weight per feature and tag, and one per pair of neighbouring tags."""

    def __init__(self, examples: str = EXAMPLES, ridge: float = 0.02, rounds: int = 250) -> None:
        self.classes = _classes()
        self.cues = np.array([_hashes(np.array([ord(c) for c in w], dtype=np.uint32), np.array([0]))[0] for w in CUES])
        self.weights = np.zeros((Shapes.COUNT, TAGS))
        self.moves = np.zeros((TAGS, TAGS))
        rows = [r for r in map(labelled, filter(None, examples.split("\n"))) if r[1]]
        self._fit([(Shapes([text], self.classes, self.cues), np.array(tags)) for text, tags in rows], ridge, rounds)
        # Emissions of the classes that occur in a word are summed for all sets of classes at once.
        sets = np.arange(1 << 16)
        self.sets = sum(np.where(sets[:, None] >> b & 1, self.weights[Shapes.OWN + b], 0.0) for b in range(1, 16))
        #: What a tag can gain over "none" by the moves before and after it, at most.
        self.gain = (self.moves - self.moves[:, :1]).max(axis=0) + (self.moves - self.moves[:1]).max(axis=1)
        #: What the moves can add to a run of other tags than "none": half a move to each word beside it, and the outer halves.
        spare = np.maximum(self.moves - self.moves[0, 0], 0)
        self.half = (spare.max(axis=0) + spare.max(axis=1)) / 2
        self.edge = (spare[0].max() + spare[:, 0].max()) / 2

    def _features(self, shapes: Shapes) -> np.ndarray:
        dense = np.zeros((len(shapes.starts), Shapes.COUNT))
        for b in range(1, 16):
            dense[:, Shapes.OWN + b] = shapes.patterns >> b & 1
        np.put_along_axis(dense, shapes.ids, 1.0, axis=1)
        return dense

    def _fit(self, rows: list[tuple[Shapes, np.ndarray]], ridge: float, rounds: int) -> None:
        """Maximum likelihood with a quadratic penalty, by Adam steps over the whole table; sequences are padded side by side."""
        longest = max(len(t) for _, t in rows)
        features = np.zeros((len(rows), longest, Shapes.COUNT))
        tags = np.zeros((len(rows), longest), dtype=np.int64)
        there = np.zeros((len(rows), longest), dtype=bool)
        for i, (shapes, t) in enumerate(rows):
            features[i, :len(t)], tags[i, :len(t)], there[i, :len(t)] = self._features(shapes), t, True
        one = np.eye(TAGS)
        flat, pairs = features.reshape(-1, Shapes.COUNT), there[:, 1:]
        seen = flat.T @ (one[tags] * there[..., None]).reshape(-1, TAGS)
        moved = np.einsum("nta,ntb->ab", one[tags[:, :-1]] * pairs[..., None], one[tags[:, 1:]])
        theta = [self.weights, self.moves]
        first, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
        for step in range(1, rounds + 1):
            emit = features @ theta[0]
            ahead, behind = np.zeros_like(emit), np.zeros_like(emit)
            ahead[:, 0] = emit[:, 0]
            for t in range(1, longest):
                ahead[:, t] = np.where(there[:, t, None], emit[:, t] + _logsum(ahead[:, t - 1, :, None] + theta[1], 1), ahead[:, t - 1])
            for t in range(longest - 2, -1, -1):
                behind[:, t] = np.where(there[:, t + 1, None], _logsum(theta[1] + (emit[:, t + 1] + behind[:, t + 1])[:, None, :], 2), 0)
            total = _logsum(ahead[:, -1], 1)
            single = np.exp(ahead + behind - total[:, None, None]) * there[..., None]
            double = np.exp(ahead[:, :-1, :, None] + theta[1] + (emit + behind)[:, 1:, None, :] - total[:, None, None, None]) * pairs[..., None, None]
            slopes = [seen - flat.T @ single.reshape(-1, TAGS) - ridge * theta[0], moved - double.sum((0, 1)) - MOVE_RIDGE * theta[1]]
            for x, g, m, v in zip(theta, slopes, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)

    def decode(self, shapes: Shapes) -> np.ndarray:
        """The best tag of every word, by Viterbi.

        Where every other tag would lose against "none" even with the best moves before
        and after it, "none" is certain.  Such words cut the texts into stretches that do
        not influence each other; those with a word that can gain at all are decoded side
        by side, the longest ones first.
        """
        tags = np.zeros(len(shapes.starts), dtype=np.int64)
        if not len(tags):
            return tags
        emit = self.sets[shapes.patterns] + sum(self.weights[column] for column in shapes.ids.T)
        open_ = (emit[:, 1:] + self.gain[1:] >= emit[:, :1]).any(axis=1)
        tails = np.concatenate([shapes.heads[1:], [True]])
        before = np.concatenate([[False], open_[:-1]]) & ~shapes.heads
        after = np.concatenate([open_[1:], [False]]) & ~tails
        begins, lasts = np.flatnonzero(open_ & ~before), np.flatnonzero(open_ & ~after)
        # A run of other tags gains at most what its words gain one by one: without a word that gains, a stretch is all "none".
        gains = np.concatenate([[0], np.cumsum((emit[:, 1:] + self.half[1:] + self.edge >= emit[:, :1]).any(axis=1))])
        worth = gains[lasts + 1] > gains[begins]
        begins, lasts = begins[worth], lasts[worth]
        if not len(begins):
            return tags
        sizes = lasts - begins + 1
        order = np.argsort(-sizes, kind="stable")
        begins, sizes, lasts = begins[order], sizes[order], lasts[order]
        best, back = [], []
        for t in range(sizes[0]):
            alive = int(np.searchsorted(-sizes, -t, side="left"))  # stretches longer than t
            at = begins[:alive] + t
            if t == 0:
                # Before and after a stretch stands a certain "none", or the edge of the text.
                score = emit[at] + np.where(shapes.heads[at][:, None], 0.0, self.moves[0])
                back.append(None)
            else:
                reach = best[-1][:alive, :, None] + self.moves
                back.append(reach.argmax(axis=1))
                score = emit[at] + reach.max(axis=1)
            best.append(score)
        end = np.empty(len(begins), dtype=np.int64)
        for size in np.unique(sizes):
            which = np.flatnonzero(sizes == size)
            leave = np.where(tails[lasts[which]][:, None], 0.0, self.moves[:, 0])
            end[which] = (best[size - 1][which] + leave).argmax(axis=1)
        for t in range(sizes[0] - 1, -1, -1):
            alive = int(np.searchsorted(-sizes, -t, side="left"))
            tags[begins[:alive] + t] = end[:alive]
            if t:
                end[:alive] = back[t][np.arange(alive), end[:alive]]
        return tags

    def spans(self, texts: list[str]) -> list[list[Span]]:
        """(start, kind, stop) of what the tags mark in each text, without signs around it."""
        shapes = Shapes(texts, self.classes, self.cues)
        tags = self.decode(shapes)
        found: list[list[Span]] = [[] for _ in texts]
        previous = -2
        for i in np.flatnonzero(tags):
            kind, inside = divmod(int(tags[i]) - 1, 2)
            owner = int(shapes.owner[i])
            start, stop = (int(x) - int(shapes.offsets[owner]) for x in (shapes.starts[i], shapes.stops[i]))
            if inside and previous == i - 1 and found[owner] and found[owner][-1][1] == kind:
                found[owner][-1] = (found[owner][-1][0], kind, stop)
            else:
                found[owner].append((start, kind, stop))
            previous = i
        return [[s for s in (_trimmed(text, *f) for f in spans) if plausible(text, s)]
                for text, spans in zip(texts, found, strict=True)]


def _logsum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(values - top).sum(axis=axis))


def _trimmed(text: str, start: int, kind: int, stop: int) -> Span:
    while stop > start and not text[stop - 1].isalnum():
        stop -= 1
    while start < stop and not (text[start].isalnum() or (kind == 3 and text[start] in "(+")):
        start += 1
    return start, kind, stop


#: A name, "at" and a domain; a bare "at" needs a spelled dot, as "look at example.com" names no one.
SPELLED = re.compile(r"""[a-z0-9._%+-]+(?:
    \ ?(?:@|[(\[{]\ ?at\ ?[)\]}])\ ?[a-z0-9-]+(?:(?:\.|\ ?[(\[{]\ ?dot\ ?[)\]}]\ ?|\ dot\ )[a-z0-9-]+)+
    |\ at\ [a-z0-9-]+(?:(?:\ ?[(\[{]\ ?dot\ ?[)\]}]\ ?|\ dot\ )[a-z0-9-]+)+)""", re.IGNORECASE | re.VERBOSE)


def six_parts(word: str) -> bool:
    """Whether a word, without brackets and port, is an address of the sixth version."""
    word = word.split("]")[0].split("%")[0].split("/")[0]
    if len(word) > 45 or word.count(":") < 2 or not any(c.isdigit() for c in word):
        return False
    try:
        ipaddress.IPv6Address(word)
    except ValueError:
        return False
    return True


def plausible(text: str, span: Span) -> bool:
    """Whether a marked stretch can be of its kind at all."""
    start, kind, stop = span
    part = text[start:stop]
    digits = "".join(c for c in part if "0" <= c <= "9")
    if kind == 0:
        close = bool(re.search(r"[A-Za-z0-9](?:@|[(\[]at[)\]])[A-Za-z0-9]", part)) and "." in part
        return close or bool(SPELLED.fullmatch(" ".join(part.split())))
    if kind == 1:
        return any(True for _ in addresses(part)) or six_parts(part)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and not any(c.isalpha() for c in part) and len(set(digits)) > 1 and bool(re.search(r"[0-9][^0-9]+[0-9]", part))


def _pieces(line: str) -> tuple[str, list[Span]]:
    """The text of a line of the table, and what is marked in it."""
    text, marks = "", []
    for piece in re.split(r"(\{\w+\|[^}]*\})", line):
        mark = re.fullmatch(r"\{(\w+)\|(.*)\}", piece)
        if mark:
            marks.append((len(text), KINDS.index(mark[1]), len(text) + len(mark[2])))
        text += mark[2] if mark else piece
    return text, marks


def marks(line: str) -> list[Span]:
    """What is marked in a line of the table."""
    return _pieces(line)[1]


def labelled(line: str) -> tuple[str, list[int]]:
    """The text of a line of the table, and the tag of each of its words."""
    text, marked = _pieces(line)
    tags, previous = [], None
    for word in WORDS.finditer(text):
        hit = next((m for m in marked if m[0] < word.end() and word.start() < m[2]), None)
        tags.append(0 if hit is None else 2 * hit[1] + (2 if hit == previous else 1))
        previous = hit
    return text, tags


# ---- on tables -------------------------------------------------------------------------------------------------------


def find(model: Model, texts: list[str | None]) -> Iterator[tuple[list[Span], list[Span]]]:
    """For each text the spans by the fixed rules, and all spans: the model adds those that overlap none of the former."""
    part: list[str] = []
    size = 0
    for i, text in enumerate(texts, 1):
        part.append(text or "")
        size += len(part[-1])
        if i == len(texts) or size > PART:
            for own, marked in zip(part, model.spans(part), strict=True):
                base = base_spans(own)
                added = [(a, k, b) for a, k, b in marked if not any(x < b and a < y for x, _, y in base)]
                yield base, sorted([*base, *added])
            part, size = [], 0


def detect(docs: DataFrame) -> DataFrame:
    """``docs`` without its text, with ``base`` and ``spans``: lists of (kind, start, stop) in code points.

    ``base`` holds what the fixed rules find, leftmost and without overlap per kind.  ``spans`` adds
    what the random field marks beyond that.  It reads every word by its shape and
    its neighbours, and is trained on the table in ``pii_table``.

    Null texts count as empty and have no spans.  Matches of different kinds may overlap.
    Repeated rows get equal results; other columns pass through; no rows give no rows.
    """
    model = on_workers(docs.sparkSession, Model())
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(texts: pa.Array) -> list[pa.Array]:
        found = list(find(model(), texts.to_pylist()))
        listed = lambda spans: [{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in spans]
        return [pa.array([listed(f[i]) for f in found], kind) for i in (0, 1)]

    one = "array<struct<kind:string,start:bigint,stop:bigint>>"
    return per_text(docs, f"base {one}, spans {one}", run)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))
