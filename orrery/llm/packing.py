"""Packing documents into token sequences by best-fit decreasing over the whole corpus.

Every document becomes token ids and one closing id. Documents longer than a sequence are first cut into full
windows; the rest of each is one piece. Windows with the same room left are alike, so best fit needs only
how many pieces there are of each length: a plan for the whole corpus is made from at most ``capacity`` counts, with a segment tree
over the room left that finds the tightest open window. Each piece then looks its place up by its length and
its number among the pieces of that length, which tasks count on their own and a running sum over tasks
makes global.

Results for odd inputs: a null or empty text is the closing id alone; repeated rows are packed as often as
they occur; a very long text is cut, never shortened; an empty table gives no rows; other columns are not used.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.text import chunks
from orrery.session import scratch

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part int, nth long"
)
RESULT = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)
#: Words whose ids a worker remembers before it starts afresh.
REMEMBERED = 500_000

# A run of Latin letters before closing punctuation: the tokenizer splits them there in any case.
_CLOSED = r"([a-zA-ZÀ-ÖØ-öø-ÿ])([.,!%&*$#]+)([\t\n\v\f\r ]|$)"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts, word by word: words between ASCII spaces are encoded once and remembered.

    This equals encoding whole texts for tokenizers that fold case, drop white space, never merge across it and
    keep letters and punctuation apart.
    """

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ids: dict[str, bytes] = {}

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each distinct word, as unsigned little-endian 32-bit numbers."""
        if len(self.ids) > REMEMBERED:
            self.ids.clear()
        new = [w for w in words if w not in self.ids]
        for word, coded in zip(new, self.tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self.ids[word] = np.array(coded.ids, "<u4").tobytes()
        return [self.ids[w] for w in words]

    def _fewer_words(self, texts: pa.Array) -> pa.Array:
        """Texts with the same ids but fewer distinct words: A-Z folded, closing punctuation set apart.

        The names of special tokens are told by their case, so texts that may hold one are left as they are.
        """
        if pc.any(pc.match_substring(texts, "<|")).as_py():
            return texts
        return pc.replace_substring_regex(pc.ascii_lower(texts), _CLOSED, r"\1 \2\3")

    def texts(self, texts: pa.Array, closing: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text's followed by ``closing``, and where each text ends."""
        lists = pc.ascii_split_whitespace(self._fewer_words(pc.fill_null(texts, "")))
        rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(lists).dictionary_encode()
        known = self.words(coded.dictionary.to_pylist())
        size = np.array([len(b) // 4 for b in known], np.int64)
        begin = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(known), "<u4")
        codes = coded.indices.to_numpy(zero_copy_only=False)
        per_word = size[codes] if len(codes) else np.zeros(0, np.int64)
        ends = np.cumsum(np.bincount(rows, per_word, minlength=len(texts)).astype(np.int64) + 1)
        out = np.full(ends[-1] if len(ends) else 0, closing, "<u4")
        before = np.cumsum(per_word) - per_word
        source = np.repeat(begin[codes] - before, per_word) + np.arange(per_word.sum())
        # Each text before this one has put one closing id in between.
        out[np.arange(per_word.sum()) + np.repeat(rows, per_word)] = pool[source]
        return out, ends


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def cut(df: DataFrame, doc_id: str, text: str, *, path: str, capacity: int, closing: int) -> DataFrame:
    """One row per piece with its task and its number among the task's pieces of its length."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows in chunks(batch, "text"):
                ids, ends = encoder.texts(rows.column("text"), closing)
                tokens = np.diff(ends, prepend=0)
                count = -(-tokens // capacity)
                row = np.repeat(np.arange(len(tokens)), count)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * capacity
                length = np.minimum(capacity, tokens[row] - start)
                first = (ends - tokens)[row] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist())]
                nth = np.empty(len(row), np.int64)
                order = np.argsort(length, kind="stable")
                in_order = length[order]
                group = np.flatnonzero(np.diff(in_order, prepend=-1))
                sizes = np.diff(np.append(group, len(row)))
                nth[order] = np.arange(len(row)) - np.repeat(group, sizes) + seen[in_order]
                seen += np.bincount(length, minlength=capacity + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("doc_id").take(pa.array(row)), pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
                        pa.array(tokens[row], pa.int64()), pa.array(np.full(len(row), part), pa.int32()),
                        pa.array(nth, pa.int64()),
                    ],
                    names=[f.split()[0] for f in PIECES.split(", ")],
                )

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(pieces, PIECES)


class Rooms:
    """Open windows by the room left in them; a segment tree over rooms finds the tightest that is large enough."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)
        self.windows: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, count: int) -> None:
        """``count`` windows, numbered from ``first``, have this room left."""
        if room and count:
            self.windows.setdefault(room, []).append((first, count))
            self._mark(room, True)

    def take(self, room: int) -> tuple[int, int]:
        first, count = self.windows[room].pop()
        if not self.windows[room]:
            self._mark(room, False)
        return first, count

    def tightest(self, length: int) -> int | None:
        """The smallest room of at least ``length`` that some window has."""
        node = length + self.size
        if self.open[node]:
            return length
        while node > 1:
            if node % 2 == 0 and self.open[node + 1]:
                node += 1
                break
            node //= 2
        else:
            return None
        while node < self.size:
            node = 2 * node + (not self.open[2 * node])
        return node - self.size

    def _mark(self, room: int, is_open: bool) -> None:
        node = room + self.size
        self.open[node] = is_open
        while node > 1:
            node //= 2
            self.open[node] = self.open[2 * node] or self.open[2 * node + 1]


@dataclass(frozen=True)
class Plan:
    """Of the pieces of ``length``, those numbered from ``first`` on go to the sequences from ``sequence`` on."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def best_fit(counts: dict[int, int], capacity: int) -> Plan:
    """Best fit for pieces of decreasing length, many alike at a time.

    The tightest window with room r takes a piece of length n and is then tighter still, so it takes r // n
    of them before the next window of that room is touched.
    """
    rooms, opened = Rooms(capacity), 0
    steps: list[tuple[int, int, int, int]] = []
    for length in sorted(counts, reverse=True):
        left, number = counts[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, first = capacity, opened
                windows = -(-left // (capacity // length))
                opened += windows
            else:
                first, windows = rooms.take(room)
            each = room // length
            full = min(windows, left // each)
            for j in range(each if full else 0):
                steps.append((length, number, first, capacity - room + j * length))
                number += full
            rooms.add(room - each * length, first, full)
            left -= full * each
            if full < windows:
                rest = min(left, each)
                for j in range(rest):
                    steps.append((length, number, first + full, capacity - room + j * length))
                    number += 1
                left -= rest
                rooms.add(room - rest * length, first + full, 1 if rest else 0)
                rooms.add(room, first + full + bool(rest), windows - full - bool(rest))
    return Plan(*(np.array([s[i] for s in steps], np.int64) for i in range(4)))


def pack(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, tokenizer: str | None = None,
    capacity: int = 2048, closing: int = 1,
) -> DataFrame:
    """One row per piece: its document, its place there, a checksum of its ids, its sequence and place there."""
    spark = df.sparkSession
    path = scratch(spark, "pieces")
    cut(df, doc_id, text, path=tokenizer or tokenizer_path(), capacity=capacity, closing=closing).write.parquet(path)
    pieces = spark.read.schema(PIECES).parquet(path)
    per_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(best_fit(counts, capacity))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = per_task.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(before, ["length", "part"]).withColumn("nth", F.col("nth") + F.col("before"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = plan.value
        for batch in batches:
            length, nth = (batch.column(c).to_numpy() for c in ("length", "nth"))
            sequence, offset = np.empty(len(nth), np.int64), np.empty(len(nth), np.int64)
            for n in np.unique(length):
                own = p.length == n
                rows = length == n
                step = np.searchsorted(p.first[own], nth[rows], side="right") - 1
                sequence[rows] = p.sequence[own][step] + nth[rows] - p.first[own][step]
                offset[rows] = p.offset[own][step]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")),
                 pa.array(sequence), pa.array(offset)],
                names=[f.split()[0] for f in RESULT.split(", ")],
            )

    return numbered.mapInArrow(place, RESULT)
