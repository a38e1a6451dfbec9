"""The prefix trie of conversations, found by digests of blocks of turns.

A node is a distinct sequence of first turns; its members are the conversations that begin with it. Conversations are cut
into blocks of a fixed number of turns, and each block boundary gets the digest of all blocks up to it. Conversations are
grouped by these digests, so copies of a stretch become one block with its number of members before any single turn is
looked at. A block without a sibling, one that no other block follows the same boundary with, holds a plain path: its turns have its
members. Only blocks that have siblings are cut up: the digests after each of their turns are grouped over the
siblings, which finds the turn where they part.

Sums over subtrees need no walk along the trie. A conversation passes through a node exactly if it is a member, so a sum over the
distinct nodes below is a sum over members of what lies behind that point on their own path, each node being counted on
the path of its smallest member only. That is one running sum per conversation and one grouped sum per node.

Turns are told apart by 128 bits of a SHA-256 of role and text, sequences by two 64-bit digests per boundary. The order of turns is made by a
range-partitioned sort, in which a long conversation spreads over tasks, and positions go on from task to task. The ids of
members that end at a node are joined in pieces of bounded size, which a task then hashes one after the other.

Results for odd inputs: turns are ordered by turn (null first), then role, then text; repeated rows are turns of their own; null
roles and texts are empty ones; rows without a conversation's id belong to none and are left out; a conversation
that is left without turns ends at the root; an empty table gives no rows, not even a root; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.components import store

#: Turns in a block, and ids in a piece of the list of members that end at a node.
BLOCK = 4
PIECE_BITS = 12
#: Blocks of a conversation that one task adds up; longer ones are added up in sections.
SECTION = 4096


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by conversation, each with its place among the task's turns of its conversation."""
    part, last, seen = TaskContext.get().partitionId(), None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv_id").to_numpy()
        new = np.append(ids[0] != last, ids[1:] != ids[:-1])
        begin = np.flatnonzero(new)
        if not new[0]:
            begin = np.append(0, begin)
        size = np.diff(np.append(begin, len(ids)))
        at = np.arange(len(ids)) - np.repeat(begin, size)
        if not new[0]:
            at[: size[0]] += seen
        last, seen = ids[-1], int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id"), pa.array(at), pa.array(np.full(len(ids), part, np.int32)), batch.column("said"), batch.column("chars")],
            names=["conv_id", "at", "part", "said", "chars"],
        )


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, at, said, chars): each turn's place in its conversation from 0 on, its digest and its length."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    said = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 32)
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), role, text]
    sorted_ = turns.where("conv_id is not null").repartitionByRange(*order).sortWithinPartitions(*order)
    placed = store(
        sorted_.select("conv_id", said.alias("said"), F.length(text).cast("long").alias("chars"))
        .mapInArrow(_number, "conv_id long, at long, part int, said string, chars long"),
        "turns",
    )
    # One row per task: a task's first conversation may have begun in tasks before, of which it was the last one.
    tasks = sorted(
        placed.groupBy("part").agg(F.min("conv_id").alias("low"), F.max(F.struct("conv_id", "at")).alias("high")).collect()
    )
    before, offsets, held = {}, [], 0
    for part, low, high in tasks:
        held = before.get(low, 0)
        if held:
            offsets.append((part, low, held))
        before = {high["conv_id"]: high["at"] + 1 + (held if high["conv_id"] == low else 0)}
    if not offsets:
        return placed.drop("part")
    table = placed.sparkSession.createDataFrame(offsets, "part int, conv_id long, earlier long")
    return placed.join(F.broadcast(table), ["part", "conv_id"], "left").select(
        "conv_id", (F.col("at") + F.coalesce("earlier", F.lit(0))).alias("at"), "said", "chars"
    )


def grafted(turns: DataFrame, group: int, heads: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt on the first turns of the first one of their group of ids; and all their ids.

    Conversation c takes the first h turns of c - c % group (h: checksum of its id modulo ``heads``) and keeps its own
    turns after its first h. At most ``heads`` - 1 turns of a first conversation are sent to its group.
    """
    base = F.col("conv_id") - F.col("conv_id") % group
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h")
    begin = (
        turns.where((F.col("conv_id") % group == 0) & (F.col("at") < heads - 1)).groupBy(F.col("conv_id").alias("base"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "said", "chars"))).alias("begin"))
    )
    ids = turns.select("conv_id").distinct().select("conv_id", h, base.alias("base"))
    begun = store(
        ids.join(begin, "base", "left")
        .select("conv_id", "h", F.slice(F.coalesce("begin", F.array()), F.lit(1), F.col("h")).alias("begin")),
        "begun",
    )
    theirs = begun.select("conv_id", F.explode("begin").alias("t")).select("conv_id", "t.at", "t.said", "t.chars")
    taken = begin.select("base", F.size("begin").alias("n"))
    own = (
        turns.select("conv_id", "at", "said", "chars", h, base.alias("base")).where("at >= h").join(taken, "base", "left")
        .select("conv_id", (F.col("at") - F.col("h") + F.least(F.coalesce("n", F.lit(0)), "h")).alias("at"), "said", "chars")
    )
    return theirs.unionByName(own), begun.select("conv_id")


def _digests(*what: Column) -> tuple[Column, Column]:
    return tuple(F.xxhash64(F.lit(k), *what) for k in (1, 2))


def _blocks(turns: DataFrame) -> DataFrame:
    """One row per conversation and block: its turns, and the digests of all blocks before and up to it."""
    cut = turns.groupBy("conv_id", F.floor(F.col("at") / BLOCK).alias("block")).agg(
        F.array_sort(F.collect_list(F.struct("at", "said", "chars"))).alias("turns")
    )
    x1, x2 = _digests(F.col("block"), F.transform("turns", lambda t: t["said"]))
    chars = F.aggregate("turns", F.lit(0).cast("long"), lambda s, t: s + t["chars"])
    cut = cut.select(
        "conv_id", "block", F.transform("turns", lambda t: F.struct(t["said"].alias("said"), t["chars"].alias("chars"))).alias("turns"),
        chars.alias("chars"), x1.alias("x1"), x2.alias("x2"),
    )
    ends = running(store(cut, "cut"), {"x1": "e1", "x2": "e2"}, F.bit_xor, Column.bitwiseXOR)
    before = [F.col(f"e{k}").bitwiseXOR(F.col(f"x{k}")).alias(f"b{k}") for k in (1, 2)]
    return store(ends.select("conv_id", "block", "turns", "chars", "e1", "e2", *before), "blocks")


def running(rows: DataFrame, names: dict[str, str], total, add, backwards: bool = False) -> DataFrame:
    """The rows with running totals over the blocks of each conversation, its own block included.

    Each section is added up on its own; a conversation of several sections then adds the totals of the sections before.
    """
    rows = rows.withColumn("section", F.floor(F.col("block") / SECTION))
    order = lambda c: F.desc(c) if backwards else F.asc(c)
    inside = Window.partitionBy("conv_id", "section").orderBy(order("block")).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy(order("section")).rowsBetween(Window.unboundedPreceding, -1)
    several = rows.where(F.col("section") > 0).select("conv_id").distinct()
    sections = (
        rows.join(several, "conv_id", "left_semi").groupBy("conv_id", "section")
        .agg(*[total(c).alias(c) for c in names])
        .select("conv_id", "section", *[total(c).over(earlier).alias(f"{c}_earlier") for c in names])
    )
    summed = rows.withColumns({to: total(c).over(inside) for c, to in names.items()})
    return summed.join(sections, ["conv_id", "section"], "left").select(
        *[c for c in rows.columns if c != "section"],
        *[add(F.col(to), F.coalesce(f"{c}_earlier", F.lit(0).cast("long"))).alias(to) for c, to in names.items()],
    )


def _steps(blocks: DataFrame) -> DataFrame:
    """One row per turn of each distinct block, with the digests before and after it; ``parted`` where the block has siblings."""
    distinct = store(
        blocks.groupBy("block", "b1", "b2", "e1", "e2")
        .agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.any_value("turns").alias("turns")),
        "distinct",
    )
    # A block that is alone after its boundary is known by its own digest, so no boundary's blocks meet in a join.
    alone = (
        distinct.groupBy("block", "b1", "b2").agg(F.count("*").alias("m"), F.any_value("e1").alias("e1"), F.any_value("e2").alias("e2"))
        .where("m = 1").select("block", "e1", "e2", F.lit(True).alias("alone"))
    )
    marked = distinct.join(alone, ["block", "e1", "e2"], "left")
    step = marked.select("*", F.posexplode("turns").alias("k", "turn")).withColumn("said", F.transform("turns", lambda t: t["said"]))
    after = [F.col(b).bitwiseXOR(x) for b, x in zip(("b1", "b2"), _digests(F.col("block"), F.slice("said", F.lit(1), F.col("k") + 1)))]
    before = [
        F.when(F.col("k") == 0, F.col(b)).otherwise(F.col(b).bitwiseXOR(x))
        for b, x in zip(("b1", "b2"), _digests(F.col("block"), F.slice("said", F.lit(1), F.col("k"))))
    ]
    return store(
        step.select(
            "block", "e1", "e2", "conv_id", "n", (F.col("block") * BLOCK + F.col("k") + 1).alias("depth"),
            *[d.alias(f"d{k}") for k, d in enumerate(after, 1)], *[p.alias(f"p{k}") for k, p in enumerate(before, 1)],
            F.col("turn.chars").alias("chars"), F.col("alone").isNull().alias("parted"),
        ),
        "steps",
    )


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash the pieces of each node's list of ids, which come in order, one after the other."""
    key, state = None, None
    done: list[tuple] = []

    def out() -> pa.RecordBatch:
        d1, d2, sha = zip(*done)
        return pa.RecordBatch.from_arrays([pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(sha)], names=["d1", "d2", "ends_sha256"])

    for batch in batches:
        for d1, d2, ids in zip(*(batch.column(c).to_pylist() for c in ("d1", "d2", "ids"))):
            if (d1, d2) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (d1, d2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if done:
            yield out()
            done.clear()
    if key is not None:
        done.append((*key, state.hexdigest()))
        yield out()


def _ends(ends: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256) of the ids that end at each node, in numeric order."""
    piece = F.shiftright("conv_id", PIECE_BITS).alias("piece")
    pieces = ends.groupBy("d1", "d2", piece).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = pieces.repartition("d1", "d2").sortWithinPartitions("d1", "d2", "piece")
    return ordered.select("d1", "d2", "ids").mapInArrow(_hash_ids, "d1 long, d2 long, ends_sha256 string")


def prefix_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", *,
    group: int | None = None, heads: int = 6,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    With ``group`` conversations are first rebuilt by ``grafted``; else they are taken as they are.
    """
    turns = ordered_turns(conversations.select(
        F.col(conv_id).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    ))
    if group is None:
        rebuilt, ids = turns, turns.select("conv_id").distinct()
    else:
        rebuilt, ids = grafted(turns, group, heads)
    blocks = _blocks(rebuilt)
    steps = _steps(blocks)
    digest = ["d1", "d2", "depth"]
    found = steps.where("not parted").select(*digest, "p1", "p2", "n", "conv_id", "chars").unionByName(
        steps.where("parted").groupBy(*digest).agg(
            F.any_value("p1").alias("p1"), F.any_value("p2").alias("p2"), F.sum("n").alias("n"),
            F.min("conv_id").alias("conv_id"), F.max("chars").alias("chars"),
        ).select(*digest, "p1", "p2", "n", "conv_id", "chars")
    )
    children = found.groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("n_children"))
    nodes = store(found.join(children, ["d1", "d2"], "left").fillna(0, ["n_children"]), "nodes")

    # What lies behind each block on a conversation's path: all turns, and nodes whose smallest member it is.
    smallest = nodes.select(*digest, F.col("conv_id").alias("smallest"))
    owned = store(
        steps.where("not parted").withColumn("own", F.col("chars")).unionByName(
            steps.where("parted").join(smallest, digest)
            .withColumn("own", F.when(F.col("conv_id") == F.col("smallest"), F.col("chars")).otherwise(0)).drop("smallest")
        ),
        "owned",
    )
    own = owned.groupBy("conv_id", "block").agg(F.sum("own").alias("own"))
    leaves = nodes.where("n_children = 0").select("conv_id", F.lit(1).cast("long").alias("leaf"))
    path = store(
        blocks.select("conv_id", "block", "e1", "e2", "chars").join(own, ["conv_id", "block"], "left").fillna(0, ["own"]), "path"
    )
    tails = (
        running(path, {"chars": "all_on", "own": "own_on"}, F.sum, Column.__add__, backwards=True)
        .join(leaves, "conv_id", "left")
        .groupBy("block", "e1", "e2")
        .agg(
            F.sum(F.col("all_on") - F.col("chars")).alias("all_behind"),
            F.sum(F.col("own_on") - F.col("own")).alias("own_behind"), F.sum(F.coalesce("leaf", F.lit(0))).alias("leaf"),
        )
    )
    rest = Window.partitionBy("block", "e1", "e2").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    below = owned.join(tails, ["block", "e1", "e2"]).select(
        *digest, "leaf",
        (F.col("all_behind") + F.col("n") * F.sum("chars").over(rest)
         - F.col("own_behind") - F.sum("own").over(rest)).alias("saved"),
    ).groupBy(*digest).agg(F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))

    last = blocks.groupBy("conv_id").agg(F.max(F.struct("block", "e1", "e2")).alias("end"))
    ended = store(
        ids.join(last, "conv_id", "left").select(
            "conv_id", *[F.coalesce(f"end.e{k}", F.lit(0).cast("long")).alias(f"d{k}") for k in (1, 2)]
        ),
        "ended",
    )
    root = ended.agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")).first()
    none = F.sha2(F.lit("").cast("binary"), 256)
    shas = store(_ends(ended), "ends")
    known = nodes.join(below, digest).join(shas, ["d1", "d2"], "left")
    # The root is known, so its children, which may be most nodes, need no join.
    parents = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    deep = known.where("depth > 1").join(parents, ["p1", "p2"])
    top = known.where("depth = 1").withColumn("parent_conv_id", F.lit(root["conv_id"]).cast("long"))
    fields = [
        "conv_id", "depth", "parent_conv_id", F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    ]
    result = store(deep.select(*fields).unionByName(top.select(*fields)), "trie")
    if not root["n"]:
        return result
    sha = shas.where("d1 = 0 and d2 = 0").first()
    top = result.where("depth = 1").agg(F.count("*"), F.sum("n_leaves"), F.sum("saved_tokens")).first()
    row = (
        root["conv_id"], 0, None, root["n"], top[0], top[1] or 1, top[2] or 0,
        sha["ends_sha256"] if sha else hashlib.sha256().hexdigest(),
    )
    return result.unionByName(result.sparkSession.createDataFrame([row], result.schema))
