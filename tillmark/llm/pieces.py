"""SentencePiece encoding and decoding, with giant documents encoded in independent chunks."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmark.llm.common import in_small_batches, on_workers, per_text, ship, sliced, table, text_of
from tillmark.session import materialised

ship(sys.modules[__name__])

#: The vocabulary, a path on the driver; tasks get its contents.
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Code points of a chunk; longer texts are cut.  Chunks that are scanned together on the way up.
CHUNK = 32_768
FAN = 64
#: Chunks that Python holds at a time.
CHUNKS = 32
#: Words, and steps between pieces, kept between batches of a task.
CACHE = 50_000
SPACE = "▁"
#: Appended to a serialised model: the normaliser's field that puts a space before a text, set to false (the last value counts).
NO_PREFIX = b"\x1a\x02\x18\x00"
#: States at a cut are (code points before it, code points behind it) of the piece that covers the last code point before it.
EDGE = (0, 0)


class Encoder:
    """The vocabulary, and what can stand next to what.

    Merging neighbours in order of their scores gives the only way to cut a text in
    which every piece is what its own text is cut into, and every two neighbours are what their
    joined text is cut into.  So an encoding is the one path through the pieces of a text
    on which each step is allowed: weight 0 for an allowed step, minus infinity for any other.
    """

    def __init__(self, proto: bytes) -> None:
        self.proto = proto
        self._load()

    def _load(self) -> None:
        self.library = sentencepiece.SentencePieceProcessor(model_proto=self.proto + NO_PREFIX)
        size = self.library.get_piece_size()
        plain = [i for i in range(size) if not (
            self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) or self.library.is_unused(i))]
        self.known = {self.library.id_to_piece(i): i for i in plain}
        self.longest = max(map(len, self.known))
        # No piece has a space behind another character: a text falls into words that begin with their spaces.
        assert not any(SPACE in p.lstrip(SPACE) for p in self.known)
        self.steps: dict[tuple[str, str], bool] = {}
        self.cache: dict[str, bytes] = {}

    def __getstate__(self) -> dict:
        return {"proto": self.proto}

    def __setstate__(self, state: dict) -> None:
        self.proto = state["proto"]
        self._load()

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of texts, as 32-bit numbers; a text is encoded word by word, each different word once."""
        cut = [words(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        if len(self.cache) > CACHE:
            self.cache = {}
        new = list({w for ws in cut for w in ws if w not in self.cache})
        for w, ids in zip(new, self.library.encode(new, num_threads=1), strict=True):
            self.cache[w] = np.array(ids, dtype="<i4").tobytes()
        return [b"".join(map(self.cache.__getitem__, ws)) for ws in cut]

    def piece(self, text: str) -> bool:
        """Whether the text can be a piece; a character that is not in the vocabulary is one of its own (its bytes)."""
        key = ("", text)
        if key not in self.steps:
            ids = self.library.encode(text)
            self.steps[key] = ids == [self.known[text]] if text in self.known else len(text) == 1
        return self.steps[key]

    def step(self, left: str, right: str) -> bool:
        """Whether ``right`` can follow ``left``; anything can follow nothing."""
        if not left:
            return True
        key = (left, right)
        if key not in self.steps:
            encode = self.library.encode
            self.steps[key] = encode(left + right) == encode(left) + encode(right)
        return self.steps[key]

    def walk(self, text: str, begin: int, last: str, stop: int) -> dict[int, dict[int, int]]:
        """Pieces that can be reached from ``begin``, where ``last`` ends: {end: {start: start of the piece before}}.

        Pieces start before ``stop`` and may end behind it.
        """
        found: dict[int, dict[int, int]] = {begin: {begin - len(last): -1}}
        for at in range(begin, stop):
            for start, _ in list(found.get(at, {}).items()):
                left = last if at == begin else text[start:at]
                for end in range(at + 1, min(at + self.longest, len(text)) + 1):
                    if at not in found.get(end, {}) and (end == at + 1 or text[at:end] in self.known) and self.piece(text[at:end]) and self.step(left, text[at:end]):
                        found.setdefault(end, {})[at] = start
        return found

    def back(self, text: str, found: dict[int, dict[int, int]], begin: int, start: int, end: int) -> list[str]:
        """The pieces on the way to the one from ``start`` to ``end``, itself included."""
        out: list[str] = []
        while end > begin:
            out.append(text[start:end])
            start, end = found[end][start], start
        return out[::-1]

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """Pieces that may cover the last code point before ``cut``."""
        return [(k, j) for k in range(1, self.longest + 1) for j in range(self.longest - k + 1)
                if cut >= k and cut + j <= len(text) and (k + j == 1 or text[cut - k:cut + j] in self.known) and self.piece(text[cut - k:cut + j])]

    def transfer(self, chunk: Chunk) -> list[tuple[tuple[int, int], tuple[int, int]]]:
        """The pairs of states before and after a chunk that a way leads from and to: the zeros of its matrix."""
        self._forget()
        text, first, stop = chunk.text, chunk.first, chunk.stop
        resets = chunk.resets()
        entries = [EDGE] if chunk.opens else self.states(text, first)
        if resets:
            alive = []
            for k, j in entries:
                begin, last = first + j, text[first - k:first + j]
                # The word's pieces end where the next word begins; a piece that reaches behind it is none.
                reached = begin == resets[0] or (begin < resets[0] and resets[0] in self.walk(text, begin, last, resets[0]))
                alive += [(k, j)] if reached else []
            exits = [EDGE] if chunk.closes else self._covering(self.walk(text, resets[-1], "", stop), stop)
            return [(a, b) for a in alive for b in exits]
        pairs = []
        for k, j in entries:
            found = self.walk(text, first + j, text[first - k:first + j], stop)
            exits = ([EDGE] if stop in found else []) if chunk.closes else self._covering(found, stop)
            pairs += [((k, j), b) for b in exits]
        return pairs

    @staticmethod
    def _covering(found: dict[int, dict[int, int]], cut: int) -> list[tuple[int, int]]:
        return [(cut - start, end - cut) for end, starts in found.items() if end >= cut for start in starts if start < cut]

    def chunk(self, chunk: Chunk, entry: tuple[int, int], leave: tuple[int, int]) -> bytes:
        """Ids of the pieces that start in a chunk, between two known states."""
        self._forget()
        text, first, stop = chunk.text, chunk.first, chunk.stop
        resets = chunk.resets()
        begin, last = first + entry[1], text[first - entry[0]:first + entry[1]]
        out: list[str] = []
        if resets:
            if begin < resets[0]:
                found = self.walk(text, begin, last, resets[0])
                out += self.back(text, found, begin, *self._only(found, resets[0]))
            inner = [text[a:b] for a, b in zip(resets, [*resets[1:], stop], strict=True)]
            tail = [] if chunk.closes else [inner.pop()]
            ids = [i for part in (out, inner) for w in self.library.encode(part, num_threads=1) for i in w] if out or inner else []
            if tail:
                found = self.walk(text, resets[-1], "", stop)
                ids += [i for w in self.library.encode(self.back(
                    text, found, resets[-1], stop - leave[0], stop + leave[1]), num_threads=1) for i in w]
        else:
            found = self.walk(text, begin, last, stop)
            end = self._only(found, stop) if chunk.closes else (stop - leave[0], stop + leave[1])
            ids = [i for w in self.library.encode(self.back(text, found, begin, *end), num_threads=1) for i in w]
        return np.array(ids, dtype="<i4").tobytes()

    def _forget(self) -> None:
        if len(self.steps) > CACHE:
            self.steps = {}

    @staticmethod
    def _only(found: dict[int, dict[int, int]], end: int) -> tuple[int, int]:
        return next(iter(found[end])), end

    def text(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of().__getitem__, np.frombuffer(ids, dtype="<i4").tolist())).decode("utf-8", "replace")[1:]

    def bytes_of(self) -> list[bytes]:
        """What each id stands for in a text; control pieces for nothing."""
        if not hasattr(self, "table"):
            lib, plain = self.library, frozenset(self.known.values())
            self.table = [
                bytes([int(lib.id_to_piece(i)[3:5], 16)]) if lib.is_byte(i) else
                lib.id_to_piece(i).replace(SPACE, " ").encode() if i in plain else b""
                for i in range(lib.get_piece_size())]
        return self.table


class Chunk:
    """Part of a text between ``first`` and ``stop`` of ``text``, which has some code points more on either side."""

    def __init__(self, before: str, body: str, after: str, opens: bool, closes: bool) -> None:
        self.text, self.first, self.stop = before + body + after, len(before), len(before) + len(body)
        self.opens, self.closes = opens, closes

    def resets(self) -> list[int]:
        """Where a word begins in the chunk."""
        text = self.text
        return [i for i in range(self.first, self.stop) if text[i] == SPACE and (i == 0 or text[i - 1] != SPACE)]


def words(text: str) -> list[str]:
    """A text with its spaces marked, cut before every run of them."""
    parts = text.split(SPACE)
    if "" not in parts[1:]:
        return [SPACE + p for p in parts[1:]] if not parts[0] else [parts[0], *(SPACE + p for p in parts[1:])]
    out, run = ([parts[0]] if parts[0] else []), 0
    for p in parts[1:]:
        run += 1
        if p:
            out.append(SPACE * run + p)
            run = 0
    return [*out, SPACE * run] if run else out


# ---- matrices of many chunks -----------------------------------------------------------------------------------------

Pairs = list[tuple[int, int]]


def composed(matrices: list[Pairs]) -> Pairs:
    """The max-plus product: states that ways through all matrices lead from and to."""
    product = set(matrices[0])
    for matrix in matrices[1:]:
        leads: dict[int, list[int]] = {}
        for a, b in matrix:
            leads.setdefault(a, []).append(b)
        product = {(a, c) for a, b in product for c in leads.get(b, ())}
    return sorted(product)


def resolved(matrices: list[Pairs], entry: int, leave: int) -> Pairs:
    """The states before and after each matrix on the way from ``entry`` to ``leave``."""
    reached = [{entry}]
    for matrix in matrices:
        reached.append({b for a, b in matrix if a in reached[-1]})
    out = []
    for i in range(len(matrices) - 1, -1, -1):
        before = min(a for a, b in matrices[i] if b == leave and a in reached[i])
        out.append((before, leave))
        leave = before
    return out[::-1]


def _number(state: tuple[int, int]) -> int:
    return state[0] << 8 | state[1]


def _state(number: int) -> tuple[int, int]:
    return number >> 8, number & 255


def _pairs(value) -> Pairs:
    return [(int(a), int(b)) for a, b in value]


def _listed(values: list[bytes]) -> pa.Array:
    offsets = np.cumsum([0, *(len(v) // 4 for v in values)])
    kind = pa.LargeListArray if offsets[-1] >= 1 << 31 else pa.ListArray
    return kind.from_arrays(pa.array(offsets, pa.int64() if kind is pa.LargeListArray else pa.int32()), pa.array(np.frombuffer(b"".join(values), dtype="<i4"))).cast(pa.list_(pa.int32()))


def _encode_giants(texts: DataFrame, encoder, longest: int, chunk: int, fan: int) -> DataFrame:
    """``sha`` and ``ids`` of distinct texts (``sha``, ``text``), each cut into chunks that are worked on apart.

    Up: every chunk gives the matrix of the states a way can lead from and to; the
    matrices of neighbouring chunks are multiplied, ``fan`` at a time, level by level.  Down: the
    states around the whole text are known, so those around its parts are, level by
    level.  Then every chunk is encoded between its two states.
    """
    in_small_batches(texts.sparkSession)
    # Of a piece across a cut, all but one code point may lie on either side.
    context = longest - 1
    bodies = F.regexp_extract_all(F.concat(F.lit(SPACE), F.translate("text", " ", SPACE)), F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    chunks = materialised(
        texts.select("sha", bodies.alias("bodies"))
        .select("sha", F.size("bodies").alias("parts"), F.explode(F.expr(f"""transform(bodies, (body, i) -> struct(
            i as part, if(i > 0, right(bodies[i - 1], {context}), '') as before, body,
            if(i < size(bodies) - 1, left(bodies[i + 1], {context}), '') as after))""")).alias("c"))
        .select("sha", "parts", "c.*")
        # The chunks of one text came out of one task.
        .repartition("sha", "part"), "chunks")

    def chunk_of(row: dict) -> Chunk:
        return Chunk(row["before"], row["body"], row["after"], row["part"] == 0, row["part"] == row["parts"] - 1)

    def transfers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHUNKS):
            rows = batch.to_pylist()
            pairs = [[[_number(a), _number(b)] for a, b in encoder().transfer(chunk_of(r))] for r in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("sha"), batch.column("part"), batch.column("parts"), pa.array(pairs, pa.list_(pa.list_(pa.int32())))],
                names=["sha", "part", "parts", "pairs"])

    matrix = "sha string, part int, parts int, pairs array<array<int>>"
    levels = [materialised(chunks.mapInArrow(transfers, matrix), "matrices")]
    most = chunks.agg(F.max("parts")).first()[0]

    def up(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        product = composed([_pairs(p) for p in frame["pairs"]])
        first = frame.iloc[0]
        return pd.DataFrame({"sha": [first["sha"]], "part": [first["part"] // fan], "parts": [-(-first["parts"] // fan)],
                             "pairs": [[list(p) for p in product]]})

    while most > 1:
        levels.append(materialised(levels[-1].groupBy("sha", F.expr(f"part div {fan}")).applyInPandas(up, matrix), "matrices"))
        most = -(-most // fan)

    known = levels[-1].select("sha", "part", F.lit(0).alias("entry"), F.lit(0).alias("leave"))

    def down(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("part")
        first = frame.iloc[0]
        ways = resolved([_pairs(p) for p in frame["pairs"]], int(first["entry"]), int(first["leave"]))
        return pd.DataFrame({"sha": frame["sha"], "part": frame["part"], "entry": [a for a, _ in ways], "leave": [b for _, b in ways]})

    for level in reversed(levels[:-1]):
        above = known.select("sha", F.col("part").alias("block"), "entry", "leave")
        inside = level.withColumn("block", F.expr(f"cast(part div {fan} as int)")).join(above, ["sha", "block"])
        known = materialised(inside.groupBy("sha", "block").applyInPandas(
            down, "sha string, part int, entry int, leave int"), "states")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, CHUNKS):
            ids = [encoder().chunk(chunk_of(r), _state(r["entry"]), _state(r["leave"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("sha"), batch.column("part"), _listed(ids)], names=["sha", "part", "ids"])

    parts = chunks.join(known, ["sha", "part"]).mapInArrow(encoded, "sha string, part int, ids array<int>")
    # One text's ids together are one row again, like the text was.
    return parts.groupBy("sha").agg(F.array_sort(F.collect_list(F.struct("part", "ids"))).alias("p")).select(
        "sha", F.flatten(F.col("p.ids")).alias("ids"))


# ---- on tables -------------------------------------------------------------------------------------------------------


def load(spark: SparkSession, model_file: str = MODEL_FILE):
    """A function that gives tasks the encoder, and the length of the longest piece.

    Unpacked on the driver, a class that is sent by value would take the place of this module's.
    """
    with open(model_file, "rb") as file:
        own = Encoder(file.read())
    return on_workers(spark, own), own.longest


def encode(docs: DataFrame, model_file: str = MODEL_FILE, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """``docs`` without its text, with ``ids``, the ids of its pieces, as the vocabulary's own library gives them.

    Texts of more than ``chunk`` code points are cut into chunks, wherever that falls, which are
    encoded independently once the pieces across the cuts are known; each
    different giant text is encoded once.  All others are encoded where they are.

    Null texts count as empty and have no ids.  Repeated rows get equal results; a column
    named ``ids`` is replaced; other columns pass through; no rows give no rows.
    """
    return _encoded(docs, model_file, chunk, fan, False)


def encode_decode(docs: DataFrame, model_file: str = MODEL_FILE, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """``docs`` with ``ids`` and ``text`` as :func:`decode` of :func:`encode` gives them, by one Python worker a task.

    With both one behind the other every task has two workers, each with a vocabulary, and the ids go to Python a second time.
    """
    return _encoded(docs, model_file, chunk, fan, True)


def _encoded(docs: DataFrame, model_file: str, chunk: int, fan: int, back: bool) -> DataFrame:
    encoder, longest = load(docs.sparkSession, model_file)

    def coded(texts: pa.Array) -> list[pa.Array]:
        ids = encoder().whole(texts.to_pylist())
        return [_listed(ids), *([pa.array([encoder().text(i) for i in ids], pa.string())] if back else [])]

    rest = F.struct(*[F.col(c) for c in docs.columns if c.lower() not in ("text", "ids")])
    rows = docs.select(rest.alias("_row"), text_of().alias("text"))
    short = per_text(rows.filter(F.length("text") <= chunk), "ids array<int>" + ", text string" * back, coded)
    giant = rows.filter(F.length("text") > chunk).withColumn("sha", F.sha2("text", 256))
    distinct = giant.select("sha", "text").dropDuplicates(["sha"])
    result = short
    if not giant.isEmpty():
        whole = giant.drop("text").join(_encode_giants(distinct, encoder, longest, chunk, fan), "sha").select("_row", "ids")
        result = short.unionByName(decode(whole, model_file) if back else whole)
    return result.select("_row.*", "ids", *["text"] * back)


def decode(encoded: DataFrame, model_file: str = MODEL_FILE) -> DataFrame:
    """``encoded`` with ``text``, what its ``ids`` stand for; null and no ids give an empty text.

    The text is the encoded one but for U+2581, which the vocabulary takes for a space;
    bytes that are no UTF-8 become U+FFFD.
    """
    in_small_batches(encoded.sparkSession)
    encoder, _ = load(encoded.sparkSession, model_file)
    keep = [c for c in encoded.columns if c.lower() != "text"]
    schema = encoded.select(*keep).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            column = batch.column("ids").fill_null([]) if batch.column("ids").null_count else batch.column("ids")
            texts = [encoder().text(row) for row in _rows(column)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string())], names=schema.names)

    return encoded.select(*keep).mapInArrow(run, schema)


def _rows(lists: pa.ListArray) -> Iterator[bytes]:
    # Offsets and values of a slice point into the whole array.
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield values[a:b].astype("<i4").tobytes()


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.length(text_of()).alias("n_chars"), F.sha2(text_of(), 256).alias("sha"), "text")
    return decode(encode(docs)).select(
        "doc_id", "n_chars", F.size("ids").alias("n_tokens"), "ids", (F.sha2("text", 256) == F.col("sha")).alias("exact"))
