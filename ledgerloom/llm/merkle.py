"""Merkle manifest of a dataset: a tree of SHA-256 digests whose parents keep their hash states.

Leaves of one tree ascend by rank; every ``FAN`` consecutive nodes become one
parent until one node remains. A parent is the hash of its children's hex
texts. Beside its digest it keeps the state of that hash before each child
slot, so a changed child is folded in by resuming the state of its slot with
the new child and the siblings to its right only: left siblings are never read
again.

Ranks are cut into blocks of ``SPAN`` = FAN ** DEPTH leaves. A block is lifted
by one task to its single topmost node; the topmost nodes are ranked by their
block and lifted again, so a tree of any size takes one more pass for every
factor of ``SPAN`` and no task holds more than some blocks. A hot tree (one
source with a third of all rows) is many blocks.

Digests stand in the tables as 32 bytes and enter hashes as 64 characters of
lowercase hex text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import sha256_lanes as sha
from ledgerloom.llm.shared import raw_bytes, small_batches, staged

FAN = 3
DEPTH = 9
SPAN = FAN ** DEPTH
GROUPED_ROWS = 1 << 15          # rows of whole blocks that a task works on together
DOCUMENT_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEAVES = "tree string, carried long, leaf binary, changed binary, seq long"
NODES = "tree string, block long, level int, place int, digest binary, states binary"
PATH = "array<struct<state: binary, before: binary, after: binary>>"


@dataclass
class Manifest:
    """``leaves`` (tree, rank, total, leaf, changed, carried), ``stages`` of nodes from the leaves
    upwards, ``paths`` (tree, block, path, subroot) of the first stage's blocks up to ``root``."""
    leaves: DataFrame
    stages: list[DataFrame]
    paths: DataFrame
    root: str | None


def field(value: bytes | None) -> bytes:
    """One field of a leaf: ``-`` if null, else its length in bytes, a colon and the bytes."""
    return b"-" if value is None else b"%d:%b" % (len(value), value)


def document_leaves(docs: DataFrame, where: Column, edit: Callable[[bytes], bytes]) -> DataFrame:
    """The leaf of every row, and of the row as ``edit`` changes the text of rows that meet ``where``.

    The tree of a row is its source (null sources form one tree, ordered before
    all others). Rows may repeat, any column may be null; other columns are not read.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.col(c).cast("string").alias(c) for c in DOCUMENT_FIELDS],
                       F.col("doc_id").cast("long").alias("carried"),
                       F.coalesce(where, F.lit(False)).alias("edited"),
                       F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("tree"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf, changed = [], []
            edited = b.column("edited").to_pylist()
            for row, hit in zip(zip(*[raw_bytes(b.column(c)) for c in DOCUMENT_FIELDS]), edited):
                head = hashlib.sha256(b"".join(map(field, row[:-1])))
                whole = head.copy()
                whole.update(field(row[-1]))
                leaf.append(whole.digest())
                if hit and row[-1] is not None and (text := edit(row[-1])) != row[-1]:
                    head.update(field(text))
                    changed.append(head.digest())
                else:
                    changed.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column("tree"), b.column("carried"), pa.array(leaf, pa.binary()), pa.array(changed, pa.binary())],
                ["tree", "carried", "leaf", "changed"])

    found = rows.mapInArrow(hashed, "tree string, carried long, leaf binary, changed binary")
    return found.withColumn("seq", F.monotonically_increasing_id())


def ranked(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rank`` from 0 and ``total`` of each row in its tree, by ``order`` (which must be total).

    Rows are range-partitioned by (tree, order), so a hot tree spreads over many
    tasks; each task's share of a tree is counted and the shares are summed up.
    """
    tree = F.col("tree").asc_nulls_first()
    placed = staged(rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order).select(
        "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), f"{name}-ranked")
    shares = placed.groupBy("part", "tree").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = staged(shares.select("part", "tree", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
                                  F.sum("n").over(whole).alias("total")), f"{name}-shares")
    return placed.join(shares, ["part", "tree"]).select(
        *rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("rank"), "total")


# ------------------------------------------------------------------ lifting

def _digests(column: pa.Array) -> np.ndarray:
    """A binary column of 32 bytes a row as ``(n, 32)``; nulls are zero."""
    return np.frombuffer(b"".join(v or bytes(32) for v in column.to_pylist()), np.uint8).reshape(-1, 32)


def _binary(rows: np.ndarray) -> pa.Array:
    raw = rows.tobytes()
    width = rows.shape[1]
    return pa.array([raw[i:i + width] for i in range(0, len(raw), width)] if len(rows) else [], pa.binary())


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole (tree, block) groups from sorted batches, with each row's group number."""
    held: list[pa.RecordBatch] = []
    rows = 0

    def numbered(t: pa.Table) -> np.ndarray:
        if len(t) == 0:
            return np.empty(0, np.int64)
        tree = t.column("tree").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        block = t.column("block").to_numpy()
        new = np.ones(len(t), bool)
        new[1:] = (tree[1:] != tree[:-1]) | (block[1:] != block[:-1])
        return np.cumsum(new) - 1

    for b in batches:
        if b.num_rows == 0:
            continue
        held.append(b)
        rows += b.num_rows
        if rows >= GROUPED_ROWS:
            t = pa.Table.from_batches(held).combine_chunks()
            group = numbered(t)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield t.slice(0, cut).combine_chunks(), group[:cut]
            held = t.slice(cut).to_batches()
            rows = len(t) - cut
    if rows:
        t = pa.Table.from_batches(held).combine_chunks()
        yield t, numbered(t)


def _lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of every level of each block, its leaves (level 0) included."""
    for t, group in _whole_groups(batches):
        trees, blocks = t.column("tree").combine_chunks(), t.column("block").to_numpy()
        digest = _digests(t.column("digest"))
        place = t.column("rank").to_numpy() % SPAN
        lone = t.column("total").to_numpy() <= SPAN       # the tree is this block: stop at one node
        row = np.arange(len(t))                           # a row of the group that a node belongs to
        states = None
        for level in range(DEPTH + 1):
            n = len(place)
            yield pa.RecordBatch.from_arrays(
                [trees.take(pa.array(row)), pa.array(blocks[row], pa.int64()), pa.array(np.full(n, level, np.int32)),
                 pa.array(place.astype(np.int32)), _binary(digest),
                 pa.nulls(n, pa.binary()) if states is None else _binary(states)],
                ["tree", "block", "level", "place", "digest", "states"])
            if level == DEPTH:
                break
            counts = np.bincount(group)
            go = ~(lone & (counts[group] == 1))
            group, place, lone, row, digest = group[go], place[go], lone[go], row[go], digest[go]
            if not len(group):
                break
            slot = place % FAN
            first = np.flatnonzero(slot == 0)
            width = np.diff(np.append(first, len(place)))
            text = sha.hex_blocks(digest)
            state = sha.fresh(len(first))
            kept = np.zeros((len(first), FAN * 32), np.uint8)
            for k in range(FAN):
                has = np.flatnonzero(width > k)
                kept[has, 32 * k:32 * k + 32] = sha.to_bytes(state[:, has])
                state[:, has] = sha.absorb(state[:, has], text[:, first[has] + k])
            digest, states = sha.to_bytes(sha.finish(state, width)), kept
            group, place, lone, row = group[first], place[first] // FAN, lone[first], row[first]


def _in_blocks(rows: DataFrame, *then: str) -> DataFrame:
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", *then)


def forest(leaves: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """Nodes by stage and ``(tree, digest)`` of every tree's last node, from (tree, rank, total, digest)."""
    stages, roots = [], []
    while True:
        cut = leaves.select("tree", F.floor(F.col("rank") / SPAN).alias("block"), "rank", "total", "digest")
        nodes = staged(_in_blocks(cut, "rank").mapInArrow(_lift, NODES), f"{name}-nodes")
        stages.append(nodes)
        blocks = leaves.groupBy("tree").agg(F.ceil(F.max("total") / SPAN).alias("blocks"))
        # A block's last node: place 0 of its highest level, which is DEPTH but in a lone block.
        tops = (nodes.where("place = 0").groupBy("tree", "block").agg(F.max_by("digest", "level").alias("digest"))
                .join(blocks, "tree"))
        tops = staged(tops, f"{name}-tops")
        roots.append(tops.where("blocks = 1").select("tree", "digest"))
        leaves = tops.where("blocks > 1").select("tree", F.col("block").alias("rank"), F.col("blocks").alias("total"), "digest")
        if leaves.isEmpty():
            break
    whole = roots[0]
    for r in roots[1:]:
        whole = whole.union(r)
    return stages, whole


# -------------------------------------------------------------------- paths

class _Blocks:
    """The nodes of whole blocks, found by (group, level, place)."""

    def __init__(self, group: np.ndarray, level: np.ndarray, digest: np.ndarray, states: np.ndarray):
        self.digest, self.states = digest, states
        code = group * (DEPTH + 1) + level
        groups = int(group[-1]) + 1 if len(group) else 0
        bounds = np.searchsorted(code, np.arange(groups * (DEPTH + 1) + 1))
        self.start = bounds[:-1].reshape(groups, DEPTH + 1)
        self.count = np.diff(bounds).reshape(groups, DEPTH + 1)
        self.top = (self.count > 0).sum(1) - 1          # level of the group's last node

    def step(self, group: np.ndarray, place: np.ndarray, level: int):
        """Per node: its slot, how many the run has, the run's first row and the parent's row."""
        parent = place // FAN
        width = np.minimum(FAN, self.count[group, level] - parent * FAN)
        return place % FAN, width, self.start[group, level] + parent * FAN, self.start[group, level + 1] + parent


def _nodes_of(t: pa.Table, group: np.ndarray) -> tuple[_Blocks, np.ndarray]:
    level = t.column("level").to_numpy()
    node = np.flatnonzero(level >= 0)
    states = np.frombuffer(b"".join(v or bytes(32 * FAN) for v in t.column("states").take(pa.array(node)).to_pylist()),
                           np.uint8).reshape(-1, 32 * FAN)
    return _Blocks(group[node], level[node], _digests(t.column("digest").take(pa.array(node))), states), node


def _block_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The whole path of every level-0 node: its steps in the block, then the block's own path."""
    for t, group in _whole_groups(batches):
        blocks, node = _nodes_of(t, group)
        head = np.flatnonzero(t.column("level").to_numpy() < 0)
        above = t.column("path").take(pa.array(head)).to_pylist()
        subroots = t.column("subroot").take(pa.array(head)).to_pylist()
        leaf = node[t.column("level").to_numpy()[node] == 0]
        g, place = group[leaf], t.column("place").to_numpy()[leaf]
        paths: list[list] = [[] for _ in leaf]
        where = place
        for level in range(DEPTH):
            live = np.flatnonzero(blocks.top[g] > level)
            if not len(live):
                break
            slot, width, first, parent = blocks.step(g[live], where[live], level)
            for i, s, w, f, p in zip(live.tolist(), slot.tolist(), width.tolist(), first.tolist(), parent.tolist()):
                paths[i].append({"state": blocks.states[p, 32 * s:32 * s + 32].tobytes(),
                                 "before": blocks.digest[f:f + s].tobytes(), "after": blocks.digest[f + s + 1:f + w].tobytes()})
            where = where // FAN
        whole = [own + above[k] for own, k in zip(paths, g.tolist())]
        trees = t.column("tree").combine_chunks().take(pa.array(leaf))
        rank = t.column("block").to_numpy()[leaf] * SPAN + place
        yield pa.RecordBatch.from_arrays(
            [trees, pa.array(rank, pa.int64()), pa.array(whole, _PATH_TYPE), pa.array([subroots[k] for k in g.tolist()], pa.string())],
            ["tree", "block", "path", "subroot"])


_PATH_TYPE = pa.list_(pa.struct([("state", pa.binary()), ("before", pa.binary()), ("after", pa.binary())]))


def _with_heads(nodes: DataFrame, paths: DataFrame, *more: str) -> DataFrame:
    """A block's nodes after one row that holds its path (level -1)."""
    extra = [F.col(c) for c in more]
    head = paths.select("tree", "block", F.lit(-1).alias("level"), F.lit(0).alias("place"), F.lit(None).cast("binary").alias("digest"),
                        F.lit(None).cast("binary").alias("states"), "path", "subroot",
                        *[F.lit(None).cast(nodes.schema[c].dataType).alias(c) for c in more])
    body = nodes.select("tree", "block", "level", "place", "digest", "states", F.lit(None).cast(PATH).alias("path"),
                        F.lit(None).cast("string").alias("subroot"), *extra)
    return _in_blocks(head.union(body), "level", "place")


def _paths_down(stages: list[DataFrame], trees: DataFrame, name: str) -> DataFrame:
    """``(tree, block, path, subroot)`` of the first stage's blocks, from the trees' own paths."""
    known = trees.select("tree", F.lit(0).cast("long").alias("block"), "path", "subroot")
    heads = known
    for i in range(len(stages) - 1, -1, -1):
        # Trees that end at this stage have their one block here; the others' blocks were found above.
        ends = known if i == 0 else known.join(stages[i].select("tree").distinct(), "tree", "left_semi")
        if i < len(stages) - 1:
            heads = ends.join(stages[i + 1].select("tree").distinct(), "tree", "left_anti").union(found)
        else:
            heads = ends
        if i:
            found = staged(_with_heads(stages[i], heads).mapInArrow(
                _block_paths, f"tree string, block long, path {PATH}, subroot string"), f"{name}-paths")
    return heads


def manifest(leaves: DataFrame, name: str = "merkle") -> Manifest:
    """The manifest of ``leaves`` (tree, carried, leaf, changed, seq): trees by ``tree``, leaves by
    ``carried`` (nulls first, ties by digest), subroots by ``tree`` under one root.

    No leaves: no nodes and no root.
    """
    leaves = staged(leaves, f"{name}-leaves")
    order = [F.col("carried").asc_nulls_first(), F.col("leaf"), F.col("changed").asc_nulls_first(), F.col("seq")]
    placed = ranked(leaves, order, name).withColumnRenamed("leaf", "digest")
    stages, subroots = forest(placed, name)
    subroots = staged(subroots, f"{name}-subroots")
    over = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), "digest"), [F.col("of")], f"{name}-top")
    over = staged(over, f"{name}-over")
    top_stages, top = forest(over, f"{name}-top")
    last = top.first()
    none = F.array().cast(PATH)
    crown = top.select("tree", none.alias("path"), F.lit(None).cast("string").alias("subroot"))
    crown = _paths_down(top_stages, crown, f"{name}-top")
    ways = _with_heads(top_stages[0], crown).mapInArrow(
        _block_paths, f"tree string, block long, path {PATH}, subroot string")
    ways = ways.select(F.col("block").alias("rank"), "path").join(
        over.select("rank", "of", F.lower(F.hex("digest")).alias("subroot")), "rank")
    trees = staged(ways.select(F.col("of").alias("tree"), "path", "subroot"), f"{name}-ways")
    return Manifest(placed, stages, _paths_down(stages, trees, name), last["digest"].hex() if last else None)


# ------------------------------------------------------------------ folding

def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per leaf of whole blocks: the root with its change, and the hash of its siblings on the way."""
    for t, group in _whole_groups(batches):
        blocks, node = _nodes_of(t, group)
        level, place = t.column("level").to_numpy(), t.column("place").to_numpy()
        head = np.flatnonzero(level < 0)
        above = t.column("path").take(pa.array(head)).to_pylist()
        is_leaf = level[node] == 0
        leaf = node[is_leaf]
        g, where = group[leaf], place[leaf].astype(np.int64)
        text = sha.hex_blocks(blocks.digest)
        changed = t.column("changed").take(pa.array(leaf)).to_pylist()
        own = blocks.digest[np.flatnonzero(is_leaf)]
        now = own.copy()
        for i, v in enumerate(changed):
            if v is not None:
                now[i] = np.frombuffer(v, np.uint8)
        proof, siblings = sha.fresh(len(leaf)), np.zeros(len(leaf), np.int64)
        for at in range(DEPTH):
            live = np.flatnonzero(blocks.top[g] > at)
            if not len(live):
                break
            slot, width, first, parent = blocks.step(g[live], where[live], at)
            # Resume the parent's state before this slot: left siblings are in it.
            kept = blocks.states[parent].reshape(-1, FAN, 32)[np.arange(len(live)), slot]
            state = sha.absorb(sha.to_words(kept), sha.hex_blocks(now[live]))
            for k in range(FAN):
                other = (width > k) & (slot != k)
                on = np.flatnonzero(other & (slot < k))
                state[:, on] = sha.absorb(state[:, on], text[:, first[on] + k])
                on = np.flatnonzero(other)
                proof[:, live[on]] = sha.absorb(proof[:, live[on]], text[:, first[on] + k])
                siblings[live[on]] += 1
            now[live] = sha.to_bytes(sha.finish(state, width))
            where //= FAN
        # Above the block all its leaves share one way: a step's state and siblings are given once a block.
        longest = max(map(len, above), default=0)
        lengths = np.array([len(p) for p in above], np.int64)
        for at in range(longest):
            live = np.flatnonzero(lengths[g] > at)
            steps = [p[at] if len(p) > at else None for p in above]
            state0 = sha.to_words(np.frombuffer(b"".join(s["state"] if s else bytes(32) for s in steps), np.uint8).reshape(-1, 32))
            state = sha.absorb(state0[:, g[live]], sha.hex_blocks(now[live]))
            width = np.ones(len(live), np.int64)
            for side in ("before", "after"):
                for k in range(FAN - 1):
                    has = np.array([s is not None and len(s[side]) > 32 * k for s in steps])
                    if not has.any():
                        continue
                    sib = sha.hex_blocks(np.frombuffer(b"".join(
                        s[side][32 * k:32 * k + 32] if ok else bytes(32) for s, ok in zip(steps, has)), np.uint8).reshape(-1, 32))
                    on = np.flatnonzero(has[g[live]])
                    if side == "after":
                        state[:, on] = sha.absorb(state[:, on], sib[:, g[live[on]]])
                    proof[:, live[on]] = sha.absorb(proof[:, live[on]], sib[:, g[live[on]]])
                    siblings[live[on]] += 1
                    width[on] += 1
            now[live] = sha.to_bytes(sha.finish(state, width))
        proof = sha.to_bytes(sha.finish(proof, siblings))
        subroots = t.column("subroot").take(pa.array(head)).to_pylist()
        as_text = [pa.array(sha.hex_text(x).astype("U64"), pa.string()) for x in (own, proof, now)]
        yield pa.RecordBatch.from_arrays(
            [t.column("carried").combine_chunks().take(pa.array(leaf)), as_text[0],
             pa.array([subroots[k] for k in g.tolist()], pa.string()), *as_text[1:]],
            ["carried", "leaf", "subroot", "proof_sha256", "folded_root"])


def fold(m: Manifest) -> DataFrame:
    """Per leaf ``carried, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``folded_root`` is the root with the leaf's ``changed`` digest (its own, where
    that is null) in its place and all other leaves as they are; ``proof_sha256``
    hashes the hex texts of its siblings, level by level, left to right.
    """
    at = m.leaves.select("tree", F.floor(F.col("rank") / SPAN).alias("block"), F.lit(0).alias("level"),
                         (F.col("rank") % SPAN).cast("int").alias("place"), "digest",
                         F.lit(None).cast("binary").alias("states"), "changed", "carried")
    inner = m.stages[0].where("level > 0").select("*", F.lit(None).cast("binary").alias("changed"),
                                                  F.lit(None).cast("long").alias("carried"))
    rows = _with_heads(at.unionByName(inner), m.paths, "changed", "carried")
    out = rows.mapInArrow(_fold, "carried long, leaf string, subroot string, proof_sha256 string, folded_root string")
    return out.select("carried", "leaf", "subroot", F.lit(m.root).cast("string").alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == F.lit(m.root)).alias("verified"))
