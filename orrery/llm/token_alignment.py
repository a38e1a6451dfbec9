"""Which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut the same bytes, so a token is its end in the text. Alignment runs along the two lists of ends:
while tokens are one to one both lists agree at a fixed shift, so ever longer stretches (1, 2, 4, ... tokens) are compared
at that shift and jumped. Where they differ, the two lists are followed token by token up to their next common end: that is
an irregular group, which sets the shift for what comes after it. Many stretches of a batch of texts (lanes) advance
together in numpy; a long text is cut into lanes at common ends.

A link is an A token and a B token whose bytes overlap. How many documents hold each pair of ids linked is counted over all
documents; the counts are a table that is handed to the tasks in slices of bounded size, one pass over the stored links
for each, so that no slice is large however many pairs there are.

Results for odd inputs: a text that is null or empty, or that a tokenizer does not give back byte by byte, has no tokens: counts
0 and groups ''. Names of special tokens in a text are plain text. A very long text is tokenized in parts, cut where
neither tokenizer merges. Rows are documents: repeated ones count as often as they occur, whatever their id, and a null id
stays null. An empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.components import store
from orrery.llm.packing import tokenizer_path
from orrery.llm.text import chunks

#: Characters of a text that are tokenized at a time, at least, and bytes of texts that are aligned at a time.
PART = 1 << 18
CHUNK_BYTES = 2 << 20
#: Tokens after which a lane is cut, and among how many of them a common end is looked for.
LANE = 512
LOOK = 32
#: Pairs of ids in a slice of the table of counts.
TABLE_PAIRS = 1 << 21

# Between these neither tokenizer merges: one joins a space to what follows, the other has no piece with a space inside.
_CUT = re.compile(r"(?<=[0-9A-Za-z.,;:!?]) (?=\S)")


@dataclass(frozen=True)
class Vocabulary:
    """The bytes of all tokens, one after the other, and where each id's lie."""

    pool: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(tokens: list[bytes]) -> Vocabulary:
        size = np.array([len(t) for t in tokens], np.int64)
        return Vocabulary(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        shift = np.repeat(self.begin[ids] - (np.cumsum(size) - size), size)
        return self.pool[shift + np.arange(len(shift))]


def parts(text: str) -> list[str]:
    """A text in parts to be tokenized on their own, all but the first beginning with a space."""
    found, at = [], 0
    while len(text) - at > PART and (cut := _CUT.search(text, at + PART)):
        found.append(text[at : cut.start()])
        at = cut.start()
    return [*found, text[at:]]


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level BPE from its JSON file, run by rank of the merged token; a space is put before a text."""

    def __init__(self, path: str) -> None:
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        ids = {t: i for t, i in spec["model"]["vocab"].items() if t not in special}
        merged = [ids["".join(m.split(" ") if isinstance(m, str) else m)] for m in spec["model"]["merges"]]
        if merged != sorted(merged):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        ranks = {bytes(alphabet[c] for c in t): i for t, i in ids.items()}
        tokens = [b""] * (max([*ids.values(), *special.values()]) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self.vocabulary = Vocabulary.of(tokens)
        self.coder = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        encode = self.coder.encode_ordinary
        coded = []
        for text in texts:
            first, *rest = parts(text)
            ids = encode(" " + first)
            for part in rest:
                ids += encode(part)
            coded.append(np.array(ids, np.int32))
        return coded


class Pieces:
    """A sentence-piece model, which puts a space before a text by itself."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.coder = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.coder.id_to_piece(i) for i in range(self.coder.get_piece_size())]
        self.vocabulary = Vocabulary.of([
            bytes([int(p[3:5], 16)]) if self.coder.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ])
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [parts(t) if self.cuts else [t] for t in texts]
        flat = [p[k > 0 :] for c in cut for k, p in enumerate(c)]
        coded = iter([np.array(ids, np.int32) for ids in self.coder.encode(flat, num_threads=1)])
        return [np.concatenate([next(coded) for _ in c]) for c in cut]


_LOADED: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def _tokenizers(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    if (a, b) not in _LOADED:
        _LOADED[a, b] = ByteLevel(a), Pieces(b)
    return _LOADED[a, b]


def lanes(ends_a: np.ndarray, ends_b: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first A token and B token of each lane: at the bytes where texts begin, and after some common end near
    every ``LANE``-th A token."""
    near = np.arange(LANE, len(ends_a), LANE)[:, None] + np.arange(LOOK)
    near = np.minimum(near, len(ends_a) - 1)
    common = ends_b[np.searchsorted(ends_b, ends_a[near])] == ends_a[near]
    cut = ends_a[near[np.arange(len(near)), common.argmax(axis=1)]][common.any(axis=1)]
    begin = np.union1d(texts, cut)
    begin = begin[begin < (ends_a[-1] if len(ends_a) else 0)]
    return np.searchsorted(ends_a, begin, side="right"), np.searchsorted(ends_b, begin, side="right")


def align(ends_a: np.ndarray, ends_b: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The last A token and the last B token of each group, in order.

    ``ends_a`` and ``ends_b`` are rising and end at the same byte, as do the texts in them, which begin at the bytes ``texts``.
    """
    last_a, last_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    i, j = lanes(ends_a, ends_b, texts)
    stop_a, stop_b = np.append(i[1:], len(ends_a)), np.append(j[1:], len(ends_b))
    stretch = np.ones(len(i), np.int64)
    live = np.flatnonzero(i < stop_a)
    while len(live):
        # Probe: compare a stretch of ends at the current shift.
        width = np.minimum(stretch[live], np.minimum(stop_a[live] - i[live], stop_b[live] - j[live]))
        begin = np.cumsum(width) - width
        step = np.arange(width.sum()) - np.repeat(begin, width)
        at_a, at_b = np.repeat(i[live], width) + step, np.repeat(j[live], width) + step
        differ = ends_a[at_a] != ends_b[at_b]
        run = np.minimum(np.minimum.reduceat(np.where(differ, step, len(step)), begin), width)
        jumped = step < np.repeat(run, width)
        last_a[at_a[jumped]] = last_b[at_b[jumped]] = True
        i[live] += run
        j[live] += run
        whole = run == width
        stretch[live] = np.where(whole, 2 * stretch[live], 1)
        # Irregular group: on to the next common end, after which the shift is another one.
        off = live[~whole]
        a, b = i[off], j[off]
        open_ = np.arange(len(off))
        while len(open_):
            behind = ends_a[a[open_]] - ends_b[b[open_]]
            a[open_[behind < 0]] += 1
            b[open_[behind > 0]] += 1
            open_ = open_[behind != 0]
        last_a[a] = last_b[b] = True
        i[off], j[off] = a + 1, b + 1
        live = live[i[live] < stop_a[live]]
    return np.flatnonzero(last_a), np.flatnonzero(last_b)


def links(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All A tokens and B tokens whose bytes overlap, in order: one link ends wherever a token of either ends."""
    size = int(ends_a[-1]) if len(ends_a) else 0
    marks = np.zeros((2, size + 1), np.int8)
    marks[0, ends_a] = marks[1, ends_b] = 1
    at = np.flatnonzero(marks[0] | marks[1])
    return tuple(np.cumsum(m, dtype=np.int32)[at - 1] for m in marks)


#: Ids up to seven digits, as the bytes of one number, first digit lowest; and how many digits each has.
_WRITTEN: list[tuple[np.ndarray, np.ndarray]] = []


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    if not _WRITTEN or len(_WRITTEN[0][0]) <= most:
        if most >= 10**7:
            raise ValueError("ids of more than seven digits")
        ids = np.arange(most + 1)
        length = np.maximum(np.searchsorted(10 ** np.arange(8), ids, side="right"), 1)
        written, rest = np.zeros(most + 1, np.uint64), ids.copy()
        for _ in range(int(length[-1])):
            # The last digit so far moves up, the next one comes below it.
            more = (rest > 0) | ((ids == 0) & (written == 0))
            written = np.where(more, (written << np.uint64(8)) | (48 + rest % 10).astype(np.uint64), written)
            rest //= 10
        _WRITTEN[:] = [(written, length.astype(np.uint64))]
    return _WRITTEN[0]


def written_groups(
    a: np.ndarray, b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The groups as ASCII text `a1,a2|b1;`, and where each group ends in it."""
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    place_a = np.arange(len(a)) + np.repeat(np.cumsum(size_b) - size_b, size_a)
    place_b = np.arange(len(b)) + np.repeat(np.cumsum(size_a), size_b)
    ids = np.empty(len(a) + len(b), np.int32)
    after = np.full(len(ids), ord(","), np.uint64)
    ids[place_a], ids[place_b] = a, b
    after[place_a[last_a]], after[place_b[last_b]] = ord("|"), ord(";")
    written, length = _digits(int(ids.max(initial=0)))
    size = length[ids]
    text = (written[ids] | (after << (size * np.uint64(8)))).astype("<u8").view(np.uint8).reshape(-1, 8)
    ends = np.cumsum(size + np.uint64(1))[place_b[last_b]]
    return text[np.arange(8, dtype=np.uint8) <= size.astype(np.uint8)[:, None]], ends


def _aligned(a_path: str, b_path: str, text: str, digest: bool):
    """Per document its counts, its groups and its linked pairs of ids with how often each occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = _tokenizers(a_path, b_path)
        width = len(second.vocabulary.size)
        for batch in batches:
            for rows in chunks(batch, text, CHUNK_BYTES):
                yield _align_rows(rows, text, first, second, width, digest)

    return run


def _same(vocabulary: Vocabulary, ids: np.ndarray, wanted: bytes) -> bool:
    return int(vocabulary.size[ids].sum()) == len(wanted) and vocabulary.joined(ids).tobytes() == wanted


def _align_rows(
    rows: pa.RecordBatch, text: str, first: ByteLevel, second: Pieces, width: int, digest: bool
) -> pa.RecordBatch:
    texts = rows.column(text).to_pylist()
    some = [k for k, t in enumerate(texts) if t]
    chosen = [texts[k] for k in some]
    coded = zip(some, chosen, first.encode(chosen), second.encode(chosen))
    kept = [
        (k, a, b, len(raw)) for k, t, a, b in coded
        if (raw := b" " + t.encode()) and _same(first.vocabulary, a, raw) and _same(second.vocabulary, b, raw)
    ]
    at = np.array([k for k, *_ in kept], np.int64)
    none = [np.zeros(0, np.int32)]
    a = np.concatenate([x for _, x, _, _ in kept] or none)
    b = np.concatenate([x for _, _, x, _ in kept] or none)
    bytes_ = np.array([x for *_, x in kept], np.int64)
    text_ends = np.cumsum(bytes_)
    ends_a, ends_b = np.cumsum(first.vocabulary.size[a]), np.cumsum(second.vocabulary.size[b])
    last_a, last_b = align(ends_a, ends_b, text_ends - bytes_)
    n = {name: np.zeros(len(texts), np.int64) for name in ("n_a", "n_b", "n_groups", "n_links")}
    stops = {}
    for name, ends in (("n_a", ends_a), ("n_b", ends_b), ("n_groups", ends_a[last_a])):
        stops[name] = np.searchsorted(ends, text_ends, side="right")
        n[name][at] = np.diff(stops[name], prepend=0)
    of_a, of_b = links(ends_a, ends_b)
    link_text = np.searchsorted(text_ends, ends_a[of_a], side="left")
    n["n_links"][at] = np.bincount(link_text, minlength=len(at))
    groups = [""] * len(texts)
    raw, ends = written_groups(a, b, last_a, last_b)
    raw, begin = memoryview(raw.tobytes()), 0
    for k, stop in zip(at.tolist(), stops["n_groups"].tolist()):
        end = int(ends[stop - 1])
        own = raw[begin : end - 1]
        groups[k] = hashlib.sha256(own).hexdigest() if digest else bytes(own).decode()
        begin = end
    # A chunk has few texts, so text and pair fit one number.
    pair = a[of_a].astype(np.int64) * width + b[of_b]
    span = len(first.vocabulary.size) * width
    keys, times = np.unique(link_text * span + pair, return_counts=True)
    per_text = np.zeros(len(texts), np.int64)
    per_text[at] = np.bincount(keys // span, minlength=len(at))
    offsets = pa.array(np.append(0, np.cumsum(per_text)).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [
            rows.column(0), *(pa.array(n[c]) for c in n), pa.array(groups, pa.string()),
            pa.ListArray.from_arrays(offsets, pa.array(keys % span)),
            pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
        ],
        names=["id", *n, "groups", "pairs", "times"],
    )


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many documents of a batch each pair occurs."""
    for batch in batches:
        pairs, counts = np.unique(batch.column("pairs").flatten().to_numpy(), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(counts)], names=["pair", "count"])


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, count, best): in how many documents a pair is linked, and whether none of its A id is in more."""
    counts = (
        aligned.select("pairs").mapInArrow(_count_pairs, "pair long, count long")
        .groupBy("pair").agg(F.sum("count").alias("count"))
        .withColumn("a", F.floor(F.col("pair") / width))
    )
    counts = store(counts, "pairs")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return store(
        counts.join(most, "a").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pairs"
    )


def _add_slice(shared):
    """Add to each document what its links find in one slice of the table of counts."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, count, best = shared.value
        for batch in batches:
            lists = batch.column("pairs")
            own, times = lists.flatten().to_numpy(), batch.column("times").flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
            at = np.minimum(np.searchsorted(pairs, own), max(len(pairs) - 1, 0))
            here = pairs[at] == own if len(pairs) else np.zeros(len(own), bool)
            row, at, times = row[here], at[here], times[here].astype(np.int64)
            sums = {"n_best": batch.column("n_best").to_numpy().copy(), "count_sum": batch.column("count_sum").to_numpy().copy()}
            np.add.at(sums["n_best"], row, np.where(best[at], times, 0))
            np.add.at(sums["count_sum"], row, times * count[at])
            yield pa.RecordBatch.from_arrays(
                [pa.array(sums[n]) if n in sums else batch.column(n) for n in batch.schema.names],
                names=batch.schema.names,
            )

    return add


def align_tokenizers(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, a_path: str | None = None, b_path: str | None = None,
    digest: bool = False, table_pairs: int = TABLE_PAIRS,
) -> DataFrame:
    """Per row: id, n_a, n_b, n_groups, n_links, n_best, count_sum and its groups, written ``a1,a2|b1;a3|b2,b3``.

    ``digest`` gives the SHA-256 of the groups instead ('' for none), so that the long text never leaves its task.
    """
    spark = df.sparkSession
    a_path = a_path or tokenizer_path("byte_bpe_50k.json")
    b_path = b_path or tokenizer_path("piece_bpe_32k.model")
    width = len(_tokenizers(a_path, b_path)[1].vocabulary.size)
    rows = df.select(F.col(doc_id).alias("id"), F.col(text).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    fields = f"id {kind}, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"
    found = store(rows.mapInArrow(_aligned(a_path, b_path, "text", digest), fields), "aligned")
    counts = pair_counts(found, width)
    slices = max(1, -(-counts.count() // table_pairs))
    scored = found.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    for k in range(slices):
        table = counts.where(F.col("pair") % slices == k).orderBy("pair").toArrow()
        columns = tuple(table.column(c).to_numpy() for c in ("pair", "count", "best"))
        scored = scored.mapInArrow(_add_slice(spark.sparkContext.broadcast(columns)), scored.schema)
        if slices > 1:
            scored = store(scored, "scored")
    return scored.select(
        F.col("id").alias(doc_id), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"
    )
