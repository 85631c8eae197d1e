"""A prefix trie of conversations, cut at the paths that split its sorted order.

Every distinct sequence of first turns is a node. Conversations are paths of turn
keys; sorted, all paths through a node stand side by side. So the paths are dealt
out by range:

1. Equal paths are counted as one before anything is dealt out, with their number,
   smallest id and the hash of their ids. A conversation that is copied a million
   times is one path.
2. Splitter paths are taken from a sample by hash, at even steps of the summed turns,
   each cut to the first turn that parts it from the one before. The trie of these
   paths is the skeleton; it is sent to all executors. ``SKELETON_NODES`` bounds it:
   beyond that, every second splitter is left out.
3. A node that is no prefix of a splitter has all its paths in one range (shard). Each
   shard sorts its paths and finishes those nodes with a stack of the open ones.
4. Skeleton nodes may spread over shards. Each shard gives its part of their sums,
   which are added up, and one task carries the sums from child to parent; it holds the
   skeleton only.

A turn is identified by the first 16 bytes of the SHA-256 of its role and text. A
conversation is one row of some 20 bytes for each turn, so one of a million turns takes
20 MB in a task; text lengths do not matter. Ids of equal paths are hashed as a stream of packed
chunks in ascending order, so their number takes no memory.

Null role or text: empty. A null turn comes before all others; equal turns
are ordered by length and key of their text. Rows without a conversation id belong to no
conversation and are left out. Repeated rows are turns of their own. Empty table: no
node. Other columns are ignored.
"""

import bisect
import hashlib
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arenalake.llm.store import stored

#: Turns of different paths in a shard, on average.
SHARD_TURNS = 16_384
#: Paths looked at for each shard to choose splitters.
SAMPLE_PATHS = 32
SKELETON_NODES = 200_000
#: Ids in a packed chunk.
CHUNK_IDS = 1024
NO_IDS = hashlib.sha256(b"").hexdigest()

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
NODE_DDL = f"{NODE}, ends_sha256 string"
#: ``skeleton``: number of a skeleton node whose part this is; ``below``: the skeleton node that is the parent.
PART_DDL = f"{NODE_DDL}, skeleton long, below long, size long"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


def turn_paths(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: of each conversation the key and the code points of its turns, in order."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in ("role", "text"))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        F.length(text).cast("long").alias("size"),
        F.unhex(F.substring(F.sha2(content, 256), 1, 32)).alias("key"),
    )
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("t"))
    lists = rows.where("conv_id is not null").groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda x: F.struct(x["key"], x["size"])).alias("turns"))


def with_openings(paths: DataFrame, every: int, most: int, taken: Column) -> DataFrame:
    """Replace the first ``taken`` (below ``most``) turns by those of the conversation ``conv_id - conv_id % every``.

    Fewer, if that one has fewer; none, if it is absent. Turns of its own after its first ``taken`` stay.
    """
    openings = paths.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("opening_id"), F.slice("turns", 1, most).alias("opening")
    )
    both = paths.withColumn("opening_id", F.col("conv_id") - F.col("conv_id") % every).join(openings, "opening_id", "left")
    taken = taken.cast("int")
    opening = F.coalesce(F.slice("opening", F.lit(1), taken), F.slice("turns", 1, 0))
    rest = F.slice("turns", taken + 1, F.greatest(F.size("turns") - taken, F.lit(0)))
    return both.select("conv_id", F.concat(opening, rest).alias("turns"))


def _ends(rows: DataFrame) -> DataFrame:
    """``path, ends``: for each path that several conversations have, the SHA-256 of their ids, joined by commas."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, ids = None, []
        names = ["path", "least", "ids"]

        def chunk() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(
                [{"path": open_path, "least": ids[0], "ids": ",".join(map(str, ids))}], chunk_schema
            )

        for batch in batches:
            for path, conv in zip(*(batch.column(x).to_pylist() for x in ("path", "conv_id")), strict=True):
                if ids and (path != open_path or len(ids) == CHUNK_IDS):
                    yield chunk().select(names)
                    ids = []
                open_path = path
                ids.append(conv)
        if ids:
            yield chunk().select(names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_path, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for path, ids in zip(*(batch.column(x).to_pylist() for x in ("path", "ids")), strict=True):
                if path != open_path:
                    if open_path is not None:
                        done.append({"path": open_path, "ends": state.hexdigest()})
                    open_path, state = path, hashlib.sha256()
                    state.update(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pylist(done, end_schema)
        if open_path is not None:
            yield pa.RecordBatch.from_pylist([{"path": open_path, "ends": state.hexdigest()}], end_schema)

    chunk_schema = pa.schema([("path", pa.string()), ("least", pa.int64()), ("ids", pa.string())])
    end_schema = pa.schema([("path", pa.string()), ("ends", pa.string())])
    # By path and id, so that the ids of one path are packed in many tasks.
    ordered = rows.select("path", "conv_id").repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    chunks = ordered.mapInArrow(pack, "path string, least long, ids string")
    return chunks.repartition("path").sortWithinPartitions("path", "least").mapInArrow(digest, "path string, ends string")


class Skeleton:
    """The trie of the splitter paths. Node 0 is the root; parents come before their children."""

    def __init__(self, splitters: list[list[bytes]]):
        self.splitters = splitters
        self.parent, self.depth, self.child = [-1], [0], {}
        for path in splitters:
            at = 0
            for key in path:
                following = self.child.get((at, key))
                if following is None:
                    following = self.child[at, key] = len(self.parent)
                    self.parent.append(at)
                    self.depth.append(self.depth[at] + 1)
                at = following

    def shard(self, path: list[bytes]) -> int:
        return bisect.bisect_right(self.splitters, path)


def _shortened(paths: list[list[bytes]]) -> list[list[bytes]]:
    """Sorted different paths, each cut behind the first turn that parts it from the one before."""
    out, before = [], []
    for path in paths:
        common = next((k for k, (a, b) in enumerate(zip(path, before, strict=False)) if a != b), min(len(path), len(before)))
        if len(path) > common:
            out.append(path[: common + 1])
        before = path
    return out


def skeleton_of(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> Skeleton:
    """The skeleton for ``paths`` (``path``: its hash, ``turns``), which must be different."""
    weight = F.size("turns") + 1
    total, count = paths.agg(F.coalesce(F.sum(weight), F.lit(0)), F.count("*")).first()
    shards = -(-total // shard_turns)
    if shards < 2:
        return Skeleton([])
    share = min(1.0, SAMPLE_PATHS * shards / count)
    sample = paths.where(F.pmod(F.xxhash64("path"), F.lit(1 << 20)) < int(share * (1 << 20)))
    keys = F.col("turns.key").alias("keys")
    # One task, for some SAMPLE_PATHS paths of each shard.
    before = Window.orderBy("keys").rowsBetween(Window.unboundedPreceding, -1)
    sample = sample.select(keys, weight.alias("weight")).withColumn("seen", F.coalesce(F.sum("weight").over(before), F.lit(0)))
    step = shard_turns * share
    marks = sample.where(F.floor((F.col("seen") + F.col("weight")) / step) > F.floor(F.col("seen") / step))
    splitters = _shortened(sorted([bytes(key) for key in row.keys] for row in marks.select("keys").collect()))
    skeleton = Skeleton(splitters)
    while len(skeleton.parent) > SKELETON_NODES:
        splitters = splitters[::2]
        skeleton = Skeleton(splitters)
    return skeleton


class _Open:
    """A node of the path the walk stands on, with the sums of what is finished below it."""

    __slots__ = ("skeleton", "size", "n", "least", "children", "leaves", "saved", "ends", "rows")

    def __init__(self, skeleton: int | None, size: int):
        self.skeleton, self.size = skeleton, size
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = NO_IDS
        self.rows: list[dict] = []


def shard_nodes(paths: list[dict], skeleton: Skeleton) -> list[dict]:
    """Finished nodes and parts of skeleton nodes of one shard's ``paths`` (keys, sizes, n, least, ends)."""
    out: list[dict] = []
    stack = [_Open(0, 0)]

    def close() -> None:
        node, depth = stack.pop(), len(stack)
        row: dict[str, Any] = {"conv_id": node.least, "depth": depth, "n_convs": node.n, "n_children": node.children}
        row |= {"ends_sha256": node.ends, "size": node.size, "skeleton": node.skeleton}
        if node.skeleton is None:
            node.saved += (node.n - 1) * node.size
            node.leaves = node.leaves or 1
        row |= {"n_leaves": node.leaves, "saved_tokens": node.saved}
        for child in node.rows:
            child["parent_conv_id"] = node.least
        out.append(row)
        if stack:
            above = stack[-1]
            above.n += node.n
            above.least = node.least if above.least is None else min(above.least, node.least)
            if node.skeleton is None:  # those of the skeleton are carried on when all shards are summed
                above.children += 1
                above.leaves += node.leaves
                above.saved += node.saved
                if above.skeleton is None:
                    above.rows.append(row)
                else:
                    row["below"] = above.skeleton

    here: list[bytes] = []
    for path in sorted(paths, key=lambda x: x["keys"]):
        keys = path["keys"]
        common = next((k for k, (a, b) in enumerate(zip(keys, here, strict=False)) if a != b), min(len(keys), len(here)))
        while len(stack) > common + 1:
            close()
        for key, size in zip(keys[common:], path["sizes"][common:], strict=True):
            above = stack[-1].skeleton
            stack.append(_Open(None if above is None else skeleton.child.get((above, key)), size))
        end = stack[-1]
        end.n += path["n"]
        end.least = path["least"] if end.least is None else min(end.least, path["least"])
        end.ends = path["ends"]
        here = keys
    while stack:
        close()
    return out


def _finished(parts: list[dict], skeleton: Skeleton) -> list[dict]:
    """The skeleton nodes from their summed parts: children are carried into parents, last first."""
    rows = {x["skeleton"]: dict(x) for x in parts}
    for number in sorted(rows, reverse=True):
        row, above = rows[number], rows.get(skeleton.parent[number])
        row["n_leaves"] = row["n_leaves"] if row["n_children"] else 1
        row["saved_tokens"] += (row["n_convs"] - 1) * row["size"] + row.pop("saved_below", 0)
        row["n_leaves"] += row.pop("leaves_below", 0)
        if above is not None:
            row["parent_conv_id"] = above["conv_id"]
            above["n_children"] += 1
            above["leaves_below"] = above.get("leaves_below", 0) + row["n_leaves"]
            above["saved_below"] = above.get("saved_below", 0) + row["saved_tokens"]
    return list(rows.values())


def prefix_trie(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of ``paths`` (``conv_id``, ``turns``; ids differ).

    ``conv_id`` smallest member, ``depth``, ``parent_conv_id`` that of the parent (root: null), ``n_convs`` members,
    ``n_children``, ``n_leaves`` childless nodes at and below it, ``saved_tokens`` the sum at and below it of
    (members - 1) times the code points of the last turn, ``ends_sha256`` of the ids of the conversations that end here.
    """
    path = F.sha2(F.array_join(F.transform("turns.key", F.hex), ""), 256).alias("path")
    rows = stored(paths.select("conv_id", path, "turns"))
    counted = rows.groupBy("path").agg(F.count("*").alias("n"), F.min("conv_id").alias("least"))
    kinds = stored(rows.drop("path").join(counted, F.col("conv_id") == F.col("least")).drop("conv_id"))
    several = _ends(rows.join(kinds.where("n > 1").select("path"), "path", "left_semi"))
    skeleton = skeleton_of(kinds, shard_turns)
    sent = rows.sparkSession.sparkContext.broadcast(skeleton)
    single = F.when(F.col("n") == 1, F.sha2(F.col("least").cast("string"), 256))
    ready = kinds.join(several, "path", "left").select(
        F.col("turns.key").alias("keys"), F.col("turns.size").alias("sizes"), "n", "least",
        F.coalesce(single, "ends").alias("ends"),
    )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton = sent.value
        for batch in batches:
            shards = [skeleton.shard(x) for x in batch.column("keys").to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int64())], [*batch.schema.names, "shard"])

    def finish(_: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(shard_nodes(table.to_pylist(), sent.value), part_schema)

    def combine(_: tuple, table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(_finished(table.to_pylist(), sent.value), part_schema)

    part_schema = _arrow(PART_DDL)
    dealt = ready.mapInArrow(deal, "keys array<binary>, sizes array<long>, n long, least long, ends string, shard long")
    parts = stored(dealt.groupBy("shard").applyInArrow(finish, PART_DDL))
    own = F.when(F.col("ends_sha256") != NO_IDS, F.col("ends_sha256"))
    summed = parts.where("skeleton is not null").groupBy("skeleton").agg(
        F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("size").alias("size"),
        *(F.sum(x).alias(x) for x in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.coalesce(F.max(own), F.lit(NO_IDS)).alias("ends_sha256"),
    )
    top = stored(summed.groupBy(F.lit(0).alias("all")).applyInArrow(combine, PART_DDL))
    names = [x.split()[0] for x in NODE_DDL.split(", ")]
    parents = F.broadcast(top.select(F.col("skeleton").alias("below"), F.col("conv_id").alias("above")))
    below = parts.where("skeleton is null").join(parents, "below", "left")
    below = below.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return top.select(names).unionByName(below.select(names))
