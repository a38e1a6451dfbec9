"""Links between documents whose sets of word n-grams are alike, by a blocked sparse product.

Documents by n-grams form a sparse 0/1 matrix; the product with its own transpose counts the n-grams that two
documents share. Only products that can reach the wanted similarity are formed:

1. Documents with equal sets are one row of the matrix (they are linked and counted; none of their pairs is formed).
2. The matrix is dealt out by blocks of columns, which count in how many rows each n-gram occurs. A row that shares fewer than
   three quarters of its n-grams with any other row can't reach the bound and is left out.
3. The first block holds, for each row, so many of its n-grams (frequent ones last) that two rows above the bound
   must share one. Entries whose row can't reach the bound with another row of the same column are left out, by
   the sizes and by how much each row shares at all.
4. The other rows form blocks; a row's home is that of the central row it shares the most columns with, so near copies lie
   in few blocks. Central rows decide only where a row is multiplied, never whether two rows are linked.
5. Blocks with a column in common are multiplied in the first block's columns, and rows whose sums leave a link possible in
   all columns, one block of columns after the other; the sums are compared with what the two sizes ask for.

So every link is found by the product and counted, with the number of rows that have the set; of the links in a pair of blocks
only so many leave the task as connect the same rows. N-grams are held as 64-bit hashes.

Results for odd inputs: a text without words has an empty set, no link and itself as component; a text with
fewer words than n has one n-gram; rows that share an id are one document, so a link of one counts for all; each distinct
text without an id is a document of its own, whose component is null if no id can be reached; links are counted per row, to all
other rows, repeated ones as often as they occur; an empty table gives no rows; only id and text are read.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.components import connected_components, store
from orrery.llm.expressions import shielded
from orrery.llm.text import Words, chunks, find_words, mix, ngram_hashes
from orrery.operators.keys import number_rows

LAST_ID = (1 << 63) - 1
#: The bits of the table that says which rows may take part; at most so many.
MOST_BITS = 1 << 26
#: The most n-grams that a list of frequent ones may hold.
MOST_FREQUENT = 1 << 20
#: Rows and columns of a block of the product.
BLOCK_ROWS = 1024
BLOCK_COLUMNS = 1024
#: Entries that the rows of a block should have in all, so that blocks of long texts have fewer rows.
BLOCK_ENTRIES = 1 << 20
#: Entries of a pair of blocks that are sorted at a time.
RANGE_ENTRIES = 1 << 19


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct n-gram, by row and hash; shorter texts have one for all their words."""
    hashes = words.hashes()
    first = words.first
    size = np.diff(first)
    at = np.flatnonzero(words.row[: max(len(words.row) - n + 1, 0)] == words.row[n - 1 :])
    rows, found = [words.row[at]], [ngram_hashes(hashes, n)[at]]
    for k in range(1, n):
        short = np.flatnonzero(size == k)
        if len(short):
            rows.append(short)
            found.append(mix(ngram_hashes(hashes, k)[first[short]] + np.uint64(k)))
    row, hashed = np.concatenate(rows), np.concatenate(found)
    order = np.lexsort((hashed, row))
    row, hashed = row[order], hashed[order]
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (hashed[1:] != hashed[:-1])
    return row[new], hashed[new]


def _checksums(hashed: np.ndarray, cut: np.ndarray) -> list[np.ndarray]:
    """Two sums of 64 bits over each set."""
    sums = []
    for salt in (0, 0x9E3779B97F4A7C15):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix(hashed ^ np.uint64(salt)))])
        sums.append((total[cut[1:]] - total[cut[:-1]]).view(np.int64))
    return sums


def _describe(n: int):
    """Size and a 128-bit checksum of each set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words = find_words(part.column("text"), lower=True)
                row, hashed = shingle_sets(words, n)
                cut = np.searchsorted(row, np.arange(words.rows + 1))
                sums = _checksums(hashed, cut)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(np.diff(cut)), *(pa.array(s) for s in sums)],
                    names=["id", "n", "sum1", "sum2"],
                )

    return describe


def _sieve(part: pa.RecordBatch, size: int, bits: np.ndarray) -> pa.RecordBatch:
    """The rows whose id may be in the table of bits."""
    slot = part.column("slot").to_numpy() % size
    return part.filter(pa.array((bits[slot >> 5] >> (slot & 31)) & 1 == 1))


def _deal(n: int, buckets: int, size: int, bits):
    """The columns' entries by bucket: 32 bits of the hash, and the row unless the chunk has the n-gram in several rows.

    N-grams in several rows of the chunk are known to be shared; those rows are credited at once. Two n-grams
    of a bucket may agree in the 32 bits, which can only let a row through to the exact steps.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in chunks(batch, "text"):
                part = _sieve(part, size, bits.value)
                row, hashed = shingle_sets(find_words(part.column("text"), lower=True), n)
                ids = part.column("id").to_numpy()
                order = np.argsort(hashed, kind="stable")
                row, hashed = row[order], hashed[order]
                begins = np.flatnonzero(np.append(True, hashed[1:] != hashed[:-1])) if len(row) else np.zeros(0, int)
                times = np.diff(np.append(begins, len(row)))
                several = np.repeat(times > 1, times)
                credit = np.bincount(row[several], minlength=len(ids))
                # Smallest hashes first, so buckets are ranges of the hash.
                bucket = ((hashed[begins] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                low = (hashed[begins] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                owner = np.where(times > 1, -1, row[begins])
                edges = np.searchsorted(bucket, np.arange(buckets + 1))
                to, entries = [], []
                for k in np.flatnonzero(np.diff(edges)).tolist():
                    a, b = edges[k], edges[k + 1]
                    by_row = np.argsort(owner[a:b], kind="stable")
                    rows, count = np.unique(owner[a:b], return_counts=True)
                    known = np.where(rows >= 0, ids[rows], -1)
                    multi = int(count[0]) if rows[0] < 0 else 0
                    rows_, count = (known[1:], count[1:]) if multi else (known, count)
                    head = press.compress(
                        np.diff(rows_, prepend=0).tobytes() + count.astype(np.uint32).tobytes()
                    )
                    to.append(k)
                    entries.append(
                        struct.pack("<3I", multi, len(rows_), len(head)) + head + low[a:b][by_row].tobytes()
                    )
                credited = np.flatnonzero(credit)
                own = press.compress(ids[credited].tobytes() + credit[credited].astype(np.int64).tobytes())
                credits = [b""] * len(to)
                if to:
                    credits[int(hashed[0]) % len(to)] = own
                yield pa.RecordBatch.from_arrays(
                    [pa.array(to, pa.int32()), pa.array(entries, pa.binary()), pa.array(credits, pa.binary())],
                    names=["bucket", "entries", "credits"],
                )

    return deal


def _shared(parts: int):
    """How many n-grams of a bucket each row shares with some other row, packed by a hash of the row's id."""

    def shared(table: pa.Table) -> pa.Table:
        unpress, press = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=1)
        lows, owners, known, all_ids, all_n = [], [], [], [], []
        for blob in table.column("entries").to_pylist():
            multi, rows, size = struct.unpack_from("<3I", blob)
            head = unpress.decompress(blob[12 : 12 + size]) if rows else b""
            ids = np.cumsum(np.frombuffer(head, np.int64, rows))
            count = np.frombuffer(head, np.uint32, rows, 8 * rows)
            low = np.frombuffer(blob, np.uint32, -1, 12 + size)
            lows.append(low)
            owners.append(np.concatenate([np.zeros(multi, np.int64), np.repeat(ids, count)]))
            known.append(np.arange(len(low)) >= multi)
        for blob in table.column("credits").to_pylist():
            if blob:
                ids, credit = np.frombuffer(unpress.decompress(blob), np.int64).reshape(2, -1)
                all_ids.append(ids)
                all_n.append(credit)
        low, owner = np.concatenate(lows), np.concatenate(owners)
        order = np.argsort(low, kind="stable")
        low, owner = low[order], owner[order]
        same = low[1:] == low[:-1]
        hit = (np.append(same, False) | np.append(False, same)) & np.concatenate(known)[order]
        ids, times = np.unique(owner[hit], return_counts=True)
        ids, times = np.concatenate([ids, *all_ids]), np.concatenate([times, *all_n]).astype(np.int64)
        part = (mix(ids.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        ids, times, part = ids[order], times[order], part[order]
        cuts = np.flatnonzero(np.diff(part, prepend=-1))
        packed = [
            press.compress(np.diff(ids[a:b], prepend=0).tobytes() + times[a:b].astype(np.uint32).tobytes())
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(part)])
        ]
        return pa.table(
            [pa.array(part[cuts], pa.int32()), pa.array(packed, pa.binary())], names=["part", "counts"]
        )

    return shared


def _total(table: pa.Table) -> pa.Table:
    """The sum of each row's counts over all buckets."""
    unpress = zstandard.ZstdDecompressor()
    raw = [unpress.decompress(b) for b in table.column("counts").to_pylist()]
    ids = np.concatenate([np.cumsum(np.frombuffer(r, np.int64, len(r) // 12)) for r in raw])
    times = np.concatenate([np.frombuffer(r, np.uint32, -1, 8 * (len(r) // 12)) for r in raw])
    ids, where = np.unique(ids, return_inverse=True)
    return pa.table(
        [pa.array(ids), pa.array(np.bincount(where, times, minlength=len(ids)).astype(np.int64))],
        names=["id", "shared"],
    )


def _bits(ids: DataFrame) -> tuple[int, np.ndarray]:
    """A table of bits by hash of the id, for a first sieve before the exact join; at most ``MOST_BITS``."""
    size = 1 << 16
    n = ids.count()
    while size < min(16 * n, MOST_BITS):
        size *= 2
    slots = ids.select(F.pmod(F.xxhash64("id"), F.lit(size)).alias("slot"))
    words = slots.groupBy(F.expr("shiftright(slot, 5)").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(slot & 31 AS int)))").alias("bits")
    ).toArrow()
    table = np.zeros(size // 32, np.int64)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return size, table


def _sets(n: int, size: int, bits):
    """The sets of rows that pass the sieve, as sorted hashes, with their checksums."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                part = _sieve(part, size, bits.value)
                words = find_words(part.column("text"), lower=True)
                row, hashed = shingle_sets(words, n)
                cut = np.searchsorted(row, np.arange(words.rows + 1)).astype(np.int32)
                # Hashes keep their unsigned order as signed numbers if the top bit is turned.
                signed = (hashed ^ np.uint64(1 << 63)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"), *(pa.array(s) for s in _checksums(hashed, cut)),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(signed)),
                    ],
                    names=["rep", "sum1", "sum2", "grams"],
                )

    return sets


def _frequent(sets: DataFrame) -> np.ndarray:
    """N-grams in so many rows that at most ``MOST_FREQUENT`` n-grams can be in as many, and in 64 at least."""
    entries = sets.agg(F.sum("n")).first()[0] or 0
    least = max(64, -(-entries // MOST_FREQUENT))
    counted = sets.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("rows"))
    found = counted.where(F.col("rows") >= least).select("gram").toArrow()
    return np.sort(found.column("gram").to_numpy())


def _first_block(percent: int, frequent):
    """So many n-grams of each row, in one order for all rows, that two rows above the bound have one in common.

    The order is by hash with frequent n-grams last: what many rows share is no evidence for a pair.
    """

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = batch.column("grams")
            flat = grams.flatten().to_numpy()
            size = batch.column("n").to_numpy()
            row = np.repeat(np.arange(len(size)), size)
            at = np.minimum(np.searchsorted(frequent.value, flat), max(len(frequent.value) - 1, 0))
            late = frequent.value[at] == flat if len(frequent.value) else np.zeros(len(flat), bool)
            order = np.lexsort((flat, late, row))
            place = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
            chosen = order[place < np.repeat(size - -(-percent * size // 100) + 1, size)]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c).take(pa.array(row[chosen])) for c in ("id", "n", "shared")),
                    pa.array(flat[chosen]),
                ],
                names=["id", "n", "shared", "gram"],
            )

    return block


def _overlap_needed(a: Column, b: Column, percent: int) -> Column:
    """The smallest overlap with 100 * overlap >= percent * union, by the two sizes."""
    return F.ceil(F.lit(percent) * (a + b) / F.lit(100.0 + percent) - 1e-9)


def _within_reach(a: str, b: str, percent: int) -> Column:
    """No overlap exceeds what either row shares with any other; the sizes ask for at least so much."""
    needed = _overlap_needed(F.col(f"n_{a}"), F.col(f"n_{b}"), percent)
    return F.least(f"shared_{a}", f"shared_{b}") >= needed


def _shared_columns(block: DataFrame, percent: int) -> DataFrame:
    """The entries of columns that several rows have, and how central each row is: how full its columns are on
    average. Of copies that were each changed a little, the one changed least is the most central."""
    full = store(block.groupBy("gram").agg(F.count("*").alias("rows")).where("rows > 1"), "columns")
    held = store(block.join(full, "gram"), "columns")
    # Columns that only one row has count as empty ones.
    central = (F.sum("rows") / _prefix(F.first("n"), percent)).alias("central")
    rows = store(held.groupBy("id").agg(central), "central")
    return store(held.drop("rows").join(rows, "id"), "columns")


def _stars(columns: DataFrame, percent: int) -> DataFrame:
    """For each row the pivot of its columns with the largest sum over the block.

    A column's pivot, among rows of about one size, is the most central one.
    """
    kind = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / percent))).alias("kind")
    rows = columns.select("*", kind)
    pivots = store(
        rows.groupBy("gram", "kind").agg(
            F.max(F.struct("central", (-F.col("id")).alias("id"), "n", "shared")).alias("pivot"), F.count("*").alias("in")
        ).where(F.col("in") > 1).select(
            "gram", "kind", (-F.col("pivot.id")).alias("a"), F.col("pivot.n").alias("n_a"),
            F.col("pivot.shared").alias("shared_a"),
        ),
        "pivots",
    )
    pairs = rows.select(
        "gram", "kind", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("shared_b")
    ).join(pivots, ["gram", "kind"]).where((F.col("a") != F.col("b")) & _within_reach("a", "b", percent))
    return _fullest(pairs)


def _fullest(pairs: DataFrame) -> DataFrame:
    """For each row b the row a that it shares the most columns with."""
    return (
        pairs.groupBy("b", "a").agg(F.count("*").alias("sum"))
        .groupBy("b").agg(F.max(F.struct("sum", (-F.col("a")).alias("a"))).alias("best"))
        .select((-F.col("best.a")).alias("a"), "b")
    )


def _open(block: DataFrame, percent: int) -> DataFrame:
    """The entries whose row may reach the bound with another row in the same column.

    A row that shares s n-grams with any other can only be linked to rows up to a certain size; a column tells
    the smallest size, and the largest size that any row allows, among the other rows.
    """
    most = F.floor(F.col("shared") * (100.0 + percent) / percent - F.col("n") + 1e-9)
    rows = block.withColumn("most", most)
    first = store(
        rows.groupBy("gram").agg(
            F.min(F.struct("n", "id")).alias("low"), F.max(F.struct("most", "id")).alias("high"),
        ),
        "columns",
    )
    rows = store(rows.join(first, "gram"), "entries")
    second = store(
        rows.groupBy("gram").agg(
            F.min(F.when(F.col("id") != F.col("low.id"), F.col("n"))).alias("low2"),
            F.max(F.when(F.col("id") != F.col("high.id"), F.col("most"))).alias("high2"),
        ),
        "columns",
    )
    low = F.when(F.col("id") == F.col("low.id"), F.col("low2")).otherwise(F.col("low.n"))
    high = F.when(F.col("id") == F.col("high.id"), F.col("high2")).otherwise(F.col("high.most"))
    return store(
        rows.join(second, "gram").where((low <= F.col("most")) & (high >= F.col("n")))
        .select("gram", "id", "n", "shared", "central"),
        "entries",
    )


def _blocks(entries: DataFrame, families: DataFrame) -> DataFrame:
    """Rows dealt into blocks of about ``BLOCK_ROWS`` rows and ``BLOCK_ENTRIES`` n-grams, each with the pairs of
    blocks (p, q) it is needed in: where the other block has another row in one of the row's columns.

    A row lives with the rows that share its central row, or else with those of its fullest column, so
    near copies lie in few blocks; a large family is several blocks.
    """
    known = store(entries.join(families.withColumnRenamed("label", "family"), "id", "left"), "entries")
    full = store(
        known.groupBy("gram").agg(F.count("*").alias("rows"), F.min("family").alias("near")), "columns"
    )
    homes = store(
        known.join(full, "gram").groupBy("id").agg(
            F.first("family").alias("family"),
            F.max(F.struct("rows", F.coalesce("near", "gram").alias("near"))).alias("fullest"),
            F.max("n").alias("n"),
        ).select("id", "n", F.coalesce("family", "fullest.near").alias("home")),
        "homes",
    )
    parts = F.ceil(F.greatest(F.count("*") / BLOCK_ROWS, F.sum("n") / BLOCK_ENTRIES))
    size = store(homes.groupBy("home").agg(parts.alias("parts")), "homes")
    blocks = store(
        homes.join(size, "home").select(
            "id", F.xxhash64("home", F.pmod(F.xxhash64("id"), F.col("parts"))).alias("block")
        ),
        "blocks",
    )
    placed = store(entries.select("gram", "id").join(blocks, "id"), "entries")
    held = store(
        placed.groupBy("gram", F.col("block").alias("other")).agg(F.min("id").alias("low"), F.max("id").alias("high")),
        "held",
    )
    needed = (
        placed.join(held, "gram").where("low < high OR low <> id").select("id", "block", "other").distinct()
    )
    return store(
        needed.select(
            "id", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"),
            (F.col("block") <= F.col("other")).alias("left"),
        ),
        "needed",
    )


def _block_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[tuple]]]:
    """The rows of each pair of blocks, which come one after the other, with their n-grams last."""
    key, rows = None, []
    for batch in batches:
        grams = batch.column("grams")
        cut, flat = grams.offsets.to_numpy(), grams.values.to_numpy()
        columns = (batch.column(c).to_pylist() for c in ("p", "q", "id", "left", "n", "shared", "copies"))
        for i, (p, q, *fields) in enumerate(zip(*columns)):
            if (p, q) != key:
                if len(rows) > 1:
                    yield *key, rows
                key, rows = (p, q), []
            rows.append((*fields, flat[cut[i] : cut[i + 1]].copy()))
    if len(rows) > 1:
        yield *key, rows


def _overlaps(rows: list[tuple], one_block: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the rows of either side, and how many columns any two of them share."""
    left = np.array([r[1] for r in rows])
    ours = np.flatnonzero(left)
    # Rows of the same block are on both sides.
    theirs = ours if one_block else np.flatnonzero(~left)
    grams = [np.sort(r[-1]) for r in rows]
    overlap = np.zeros((len(ours), len(theirs)), np.float32)
    # N-grams are spread evenly, so ranges of them hold about as many entries each.
    ranges = 1 + sum(map(len, grams)) // RANGE_ENTRIES
    edges = [((1 << 64) * k // ranges) - (1 << 63) for k in range(1, ranges)]
    cuts = [np.concatenate([[0], np.searchsorted(g, np.array(edges, np.int64)), [len(g)]]) for g in grams]
    for k in range(ranges):
        parts = [g[c[k] : c[k + 1]] for g, c in zip(grams, cuts)]
        row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(g) for g in parts])
        flat = np.concatenate(parts)
        order = np.argsort(flat, kind="stable")
        row, flat = row[order], flat[order]
        new = np.append(True, flat[1:] != flat[:-1])[: len(flat)]
        several = ~(new & np.append(new[1:], True)[: len(flat)])
        row, column = row[several], np.cumsum(new[several]) - 1
        for first in range(0, int(column[-1]) + 1 if len(column) else 0, BLOCK_COLUMNS):
            a, b = np.searchsorted(column, [first, first + BLOCK_COLUMNS])
            block = np.zeros((len(rows), BLOCK_COLUMNS), np.float32)
            block[row[a:b], column[a:b] - first] = 1
            overlap += block[ours] @ block[theirs].T
    return ours, theirs, overlap.astype(np.int32)


def _hopeful(percent: int):
    """The rows that share enough of the first block with a row on the other side.

    Two sets above the bound have at least ``needed`` n-grams in common. Of these, at most as many lie outside the
    first block as the larger set has n-grams there; the others are common columns of the first block.
    """

    def hopeful(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, q, rows in _block_pairs(batches):
            ours, theirs, overlap = _overlaps(rows, p == q)
            ids, _, size, shared = (np.array([r[k] for r in rows]) for k in range(4))
            # Half the memory, and 100 times a size still fits.
            size, shared = size.astype(np.int32), shared.astype(np.int32)
            a, b = size[ours][:, None], size[theirs][None, :]
            needed = -(-percent * (a + b) // (100 + percent))
            outside = -(-percent * np.maximum(a, b) // 100) - 1
            reach = np.minimum(shared[ours][:, None], shared[theirs][None, :])
            pair = (overlap >= needed - outside) & (reach >= needed) & (ids[ours][:, None] != ids[theirs][None, :])
            some = np.zeros(len(rows), bool)
            some[ours[pair.any(axis=1)]] = True
            some[theirs[pair.any(axis=0)]] = True
            at = np.flatnonzero(some)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(at), p)), pa.array(np.full(len(at), q)), pa.array(ids[at]),
                    pa.array([rows[i][1] for i in at], pa.bool_()),
                ],
                names=["p", "q", "id", "left"],
            )

    return hopeful


def _product(percent: int):
    """For the rows of two blocks the documents they are linked to, and links that connect the same rows as all do."""

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, q, rows in _block_pairs(batches):
            ours, theirs, overlap = _overlaps(rows, p == q)
            ids, _, size, _, copies = (np.array([r[k] for r in rows]) for k in range(5))
            size = size.astype(np.int32)
            union = size[ours][:, None] + size[theirs][None, :] - overlap
            linked = (100 * overlap >= percent * union) & (ids[ours][:, None] != ids[theirs][None, :])
            count = np.zeros(len(rows), np.int64)
            count[ours] += linked @ copies[theirs]
            if p != q:
                count[theirs] += linked.T @ copies[ours]
            found = _tree(linked, ours, theirs, len(rows))
            some = np.flatnonzero(count)
            # A row with its count has no other end.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([ids[some], ids[found[:, 0]]])),
                    pa.array(
                        np.concatenate([np.zeros(len(some), np.int64), ids[found[:, 1]]]),
                        mask=np.arange(len(some) + len(found)) < len(some),
                    ),
                    pa.array(np.concatenate([count[some], np.zeros(len(found), np.int64)])),
                ],
                names=["a", "b", "links"],
            )

    return product


def _tree(linked: np.ndarray, ours: np.ndarray, theirs: np.ndarray, rows: int) -> np.ndarray:
    """Places of the ends of links along which each row is reached once from the first of its component."""
    side, other = np.full(rows, -1), np.full(rows, -1)
    side[ours], other[theirs] = np.arange(len(ours)), np.arange(len(theirs))
    fresh = np.ones(rows, bool)
    found = [np.zeros((0, 2), np.int64)]
    for start in range(rows):
        waiting = [start] if fresh[start] else []
        fresh[start] = False
        while waiting:
            at = waiting.pop()
            near = theirs[linked[side[at]]] if side[at] >= 0 else ours[linked[:, other[at]]]
            near = near[fresh[near]]
            fresh[near] = False
            waiting += near.tolist()
            found.append(np.stack([np.full(len(near), at), near], axis=1))
    return np.concatenate(found)


def _multiplied(
    entries: DataFrame, columns: DataFrame, sets: DataFrame, families: DataFrame, percent: int
) -> DataFrame:
    """Links among rows that share an open column and their number per row, from the products of the rows' blocks.

    The blocks are multiplied in the columns of the first block, and then, for the rows that still can have a link, in all.
    """
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = _blocks(entries, families)

    def in_blocks(rows: DataFrame) -> DataFrame:
        rows = rows.select("p", "q", "id", "left", "n", "shared", "copies", "grams")
        return rows.repartition(parts, "p", "q").sortWithinPartitions("p", "q")

    ids = entries.select("id").distinct()
    # Columns that only one row has count for no pair and are not among these.
    prefixes = store(
        columns.join(ids, "id", "left_semi").groupBy("id").agg(
            F.first("n").alias("n"), F.first("shared").alias("shared"), F.lit(0).cast("long").alias("copies"),
            F.collect_list("gram").alias("grams"),
        ),
        "prefixes",
    )
    hopeful = store(
        in_blocks(needed.join(prefixes, "id")).mapInArrow(_hopeful(percent), "p long, q long, id long, left boolean"),
        "hopeful",
    )
    return store(
        in_blocks(hopeful.join(sets, "id")).mapInArrow(_product(percent), "a long, b long, links long"), "products"
    )


def _prefix(n: Column, percent: int) -> Column:
    """So many smallest hashes of a set hold one of any set above the bound."""
    return (n - F.ceil(F.lit(percent) * n / 100.0) + 1).cast("int")


def jaccard_components(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, n: int = 5, percent: int = 75,
    bucket_entries: int = 1 << 20, part_rows: int = 1 << 16,
) -> DataFrame:
    """Per row: id, size of its set, the smallest id reachable by links of at least ``percent`` Jaccard similarity, and
    how many other rows it is linked to.

    ``bucket_entries`` and ``part_rows`` are about what one group holds while columns and then rows are counted.
    """
    spark = df.sparkSession
    rows, low, high = _numbered(df, doc_id, text)
    own = ~F.col("id").between(low, high)
    described = store(rows.mapInArrow(_describe(n), "id long, n long, sum1 long, sum2 long"), "sizes")
    same = ["n", "sum1", "sum2"]
    classes = store(described.where("n > 0").groupBy(*same).agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")
    matrix = classes.agg(F.count("*").alias("rows"), F.sum("n").alias("entries")).first()
    buckets, parts = 1 + (matrix["entries"] or 0) // bucket_entries, 1 + matrix["rows"] // part_rows
    slots = rows.withColumn("slot", F.pmod(F.xxhash64("id"), F.lit(MOST_BITS)))
    size, bits = _bits(classes.select(F.col("rep").alias("id")))
    dealt = slots.mapInArrow(
        _deal(n, buckets, size, spark.sparkContext.broadcast(bits)), "bucket int, entries binary, credits binary"
    )
    shared = (
        dealt.groupBy("bucket").applyInArrow(_shared(parts), "part int, counts binary")
        .groupBy("part").applyInArrow(_total, "id long, shared long")
    )
    # Classes of different sets may have the same smallest id.
    able = store(
        classes.join(shared.groupBy("id").agg(F.max("shared").alias("shared")), F.col("rep") == F.col("id"))
        .where(100 * F.col("shared") >= percent * F.col("n"))
        .select(F.monotonically_increasing_id().alias("id"), "rep", "n", "sum1", "sum2", "copies", "shared"),
        "able",
    )
    size, bits = _bits(able.select(F.col("rep").alias("id")))
    passed = slots.mapInArrow(
        _sets(n, size, spark.sparkContext.broadcast(bits)), "rep long, sum1 long, sum2 long, grams array<long>"
    )
    sets = store(
        passed.join(able, ["rep", "sum1", "sum2"]).where(F.size("grams") == F.col("n"))
        .select("id", "n", F.least("shared", "n").alias("shared"), "copies", "grams"),
        "sets",
    )
    if sets.count() > able.count():
        # Repeated rows have the same id and the same set.
        sets = store(sets.dropDuplicates(["id"]), "sets")
    frequent = spark.sparkContext.broadcast(_frequent(sets))
    block = store(sets.mapInArrow(_first_block(percent, frequent), "id long, n long, shared long, gram long"), "block")
    columns = _shared_columns(block, percent)
    families = connected_components(store(_stars(columns, percent), "stars"))
    products = _multiplied(_open(columns, percent), columns, sets, families, percent)
    counted = products.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    counted = store(counted.join(able, "id").select(*same, "links"), "counted")
    members = store(
        described.join(classes, same, "left").join(counted, same, "left").select(
            "id", "n", F.coalesce("rep", "id").alias("rep"),
            F.coalesce(F.coalesce("links", F.lit(0)) + F.col("copies") - 1, F.lit(0)).alias("n_links"),
        ),
        "members",
    )
    a, b = (able.select(F.col("id").alias(k), F.col("rep").alias(f"rep_{k}")) for k in "ab")
    links = products.where("b IS NOT NULL").select("a", "b").join(a, "a").join(b, "b").select("rep_a", "rep_b")
    # An id with several sets is one document.
    several = members.groupBy("id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    links = links.union(members.join(several, "id").select("id", "rep").distinct())
    labels = connected_components(store(links.toDF("a", "b"), "links"))
    labels = labels.select(F.col("id").alias("rep"), "label")
    found = members.join(labels, "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    if low > high or rows.agg(F.min("id")).first()[0] >= low:
        smallest = F.when(F.col("label").between(low, high), F.col("label"))
    else:
        # Numbers of rows without an id lie below all ids here, and so may labels.
        named = found.where(~own).groupBy(F.col("label").alias("of")).agg(F.min("id").alias("smallest"))
        found, smallest = found.join(named, F.col("label") == F.col("of"), "left"), F.col("smallest")
    return found.select(
        F.when(~own, F.col("id")).alias(doc_id), F.col("n").alias("n_shingles"), smallest.alias("component_id"), "n_links",
    )


def _numbered(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int, int]:
    """(id, text) with a number of its own for each distinct text without an id, and the smallest and largest id."""
    ids = df.agg(
        F.min(F.col(doc_id).cast("long")).alias("low"), F.max(F.col(doc_id).cast("long")).alias("high"),
        F.count_if(F.col(doc_id).isNull()).alias("unnamed"),
    ).first()
    low, high = (ids["low"], ids["high"]) if ids["low"] is not None else (0, -1)
    rows = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    if ids["unnamed"]:
        known = F.when(F.col("id").isNull(), _known(F.col("text")))
        rows = _own_numbers(rows, known, "id", "node", low, high).select(F.col("node").alias("id"), "text")
    return rows, low, high


def _known(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.substring(F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256), 1, 32)


def _own_numbers(df: DataFrame, key: Column, doc_id: str, into: str, low: int, high: int) -> DataFrame:
    """The id as it is where ``key`` is null, else a number of the key's own outside of ``low`` to ``high``, by order of keys."""
    unused = lambda name: next(n for k in range(len(df.columns) + 1) if (n := f"{name}{k}") not in df.columns)
    own, key_name, nth = unused("own"), unused("key"), unused("nth")
    numbers = number_rows(df.select(key.alias(key_name)).dropna().distinct(), nth, [key_name], unique=True)
    size, top = numbers.count(), max(high, 0)
    # Ids that are hashes may end near the largest number; then there is room before the smallest.
    base = top if top + size < LAST_ID else low - size - 1
    return df.withColumn(own, key).join(numbers, F.col(own) == F.col(key_name), "left").withColumn(
        into, F.coalesce(F.col(nth) + F.lit(base), F.col(doc_id).cast("long"))
    ).drop(own, key_name, nth)


@shielded
def own_nodes(df: DataFrame, doc_id: str, text: str, into: str) -> DataFrame:
    """A number for each distinct document: its id, or one outside of all ids if it has none or another text took its id.

    Of the texts that share an id the one with the smallest SHA-256 takes it. Rows of one id and one text share a number, and
    so do equal texts without an id.
    """
    firsts = (
        df.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("_shared_id"), _known(F.col(text)).alias("_text"))
        .groupBy("_shared_id").agg(F.min("_text").alias("_first_text"), F.max("_text").alias("_last_text"))
        .where("_first_text <> _last_text").drop("_last_text")
    )
    ids = df.agg(F.min(F.col(doc_id).cast("long")).alias("low"), F.max(F.col(doc_id).cast("long")).alias("high")).first()
    low, high = (ids["low"], ids["high"]) if ids["low"] is not None else (0, -1)
    known = _known(F.col(text))
    shared = F.col("_first_text").isNotNull() & (F.col("_first_text") != known)
    key = F.when(F.col(doc_id).isNull(), known).when(shared, F.concat(F.col("_shared_id").cast("string"), F.lit("/"), known))
    joined = df.join(firsts, F.col(doc_id) == F.col("_shared_id"), "left")
    return _own_numbers(joined, key, doc_id, into, low, high).drop("_shared_id", "_first_text")


@shielded
def keep_representatives(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", *, n: int = 5, percent: int = 75,
) -> DataFrame:
    """One document of each component: that with the smallest number of ``own_nodes``, which is the smallest id unless
    ids are null or shared by different texts; of its repeated rows one.

    Each distinct text without an id, and each of several texts that share one, is a document of its own: none goes
    unless it is linked to another one that stays.
    """
    node = next(name for k in range(len(df.columns) + 1) if (name := f"node{k}") not in df.columns)
    named = store(own_nodes(df, doc_id, text, node), "named")
    found = jaccard_components(named, node, text, n=n, percent=percent)
    kept = found.where(F.col(node) == F.col("component_id")).select(F.col(node).alias("_kept")).distinct()
    rows = named.join(kept, F.col(node) == F.col("_kept"), "left_semi")
    return rows.dropDuplicates([node]).drop(node)
