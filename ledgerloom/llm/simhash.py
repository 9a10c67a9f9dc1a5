"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints are made in Python over Arrow batches, one narrow row a document.
Equal fingerprints collapse first, so copies cost one index entry. The index
over the distinct fingerprints is a tree:

* Its upper nodes are shared masked bit patterns. The free bits are cut into
  ``radius + 2`` blocks; two fingerprints within ``radius`` bits agree on at
  least two whole blocks, so they meet under one of the masks that cover two.
* Below an upper node the fingerprints lie in Gray-rank order. Runs of them are
  factored into nodes that keep the bits all members share. A pair of nodes
  whose shared bits differ in more than ``radius`` places is pruned with all
  that lies below; the others are opened, down to the fingerprints.

An upper node with more than ``node_limit`` fingerprints is split by a further
pattern over its free bits, in the same lossless way. After three levels at
most 2**20 fingerprints can share a pattern, so a task's group is bounded.
A node hands on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import (components, free, hash_all, lower_words, raw_bytes, shingle_bytes,
                                   staged)

LEAF, FANOUT, PAIRS = 16, 8, 1 << 20


def fingerprint(text: bytes | None, shingle_words: int = 4) -> int:
    """64 bits; a bit is 1 if set in over half the shingle hashes. No words: 0."""
    words = lower_words(text)
    if not words:
        return 0
    h = hash_all(shingle_bytes(words, shingle_words), max(1, len(words) - shingle_words + 1))
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 14):
        bits = np.unpackbits(h[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 4) -> DataFrame:
    """``(doc_id, text_key, fp)`` for every row; fp is the fingerprint as a signed long,
    text_key a 64-bit hash of the text that tells rows with one id apart."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            fps = np.array([fingerprint(t, shingle_words) for t in raw_bytes(batch.column(2))], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], ["doc_id", "text_key", "fp"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.xxhash64(F.col(f"`{text_col}`")).alias("text_key"),
                         F.col(f"`{text_col}`").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, text_key long, fp long")


def gray_rank(code: np.ndarray) -> np.ndarray:
    """The place of each 64-bit code in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        code = code ^ (code >> np.uint64(shift))
    return code


def sub_masks(mask: int, radius: int) -> list[int]:
    """``mask`` with each choice of two out of ``radius + 2`` blocks of its free bits added."""
    free = [1 << i for i in range(64) if not mask >> i & 1]
    blocks = [sum(part.tolist()) for part in np.array_split(np.array(free, object), radius + 2)]
    return [mask | a | b for a, b in combinations(blocks, 2)]


def _upper_nodes(radius: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}
        for batch in rows:
            fp = batch.column(0).to_numpy().view(np.uint64)
            mask = batch.column(1).to_numpy()
            for m in np.unique(mask):
                own = fp[mask == m]
                if int(m) not in known:
                    known[int(m)] = np.array(sub_masks(int(m) & (2**64 - 1), radius), np.uint64)
                deeper = known[int(m)]
                every = np.repeat(deeper, len(own))
                codes = np.tile(own, len(deeper))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(every.view(np.int64)), pa.array((codes & every).view(np.int64)),
                     pa.array((gray_rank(codes) ^ np.uint64(1 << 63)).view(np.int64))],
                    ["mask", "pattern", "rank"])
    return run


def _forest(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """``root`` of each of n entries after joining the pairs (a, b)."""
    while True:
        ra, rb = root[a], root[b]
        if (ra == rb).all():
            return root
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not (root == root[root]).all():
            root = root[root]


def links_below(codes: np.ndarray, radius: int) -> np.ndarray:
    """For Gray-ordered ``codes`` under one upper node: the position of each one's root."""
    n, root = len(codes), np.arange(len(codes))
    levels = []  # from the leaves up: (first member, shared mask, shared bits)
    size = LEAF
    while True:
        first = np.arange(0, n, size)
        low = np.bitwise_and.reduceat(codes, first)
        mask = ~(low ^ np.bitwise_or.reduceat(codes, first))
        levels.append((mask, low & mask))
        if len(first) <= FANOUT:
            break
        size *= FANOUT
    top = len(levels[-1][0])
    stack = [(len(levels) - 1, *np.triu_indices(top))]
    while stack:
        level, i, j = stack.pop()
        if len(i) > PAIRS:
            half = len(i) // 2
            stack += [(level, i[:half], j[:half]), (level, i[half:], j[half:])]
            continue
        if level >= 0:
            mask, bits = levels[level]
            open_ = np.bitwise_count((bits[i] ^ bits[j]) & mask[i] & mask[j]) <= radius
            i, j = i[open_], j[open_]
        else:
            near = np.bitwise_count(codes[i] ^ codes[j]) <= radius
            root = _forest(n, i[near], j[near], root)
            continue
        if not len(i):
            continue
        step, count = (LEAF, n) if level == 0 else (FANOUT, len(levels[level - 1][0]))
        part = max(1, PAIRS // (step * step))
        grid_i, grid_j = (g.ravel() for g in np.meshgrid(np.arange(step), np.arange(step), indexing="ij"))
        for at in range(0, len(i), part):
            ci = (i[at:at + part, None] * step + grid_i).ravel()
            cj = (j[at:at + part, None] * step + grid_j).ravel()
            good = (ci < count) & (cj < count) & ((ci < cj) if level == 0 else (ci <= cj))
            stack.append((level - 1, ci[good], cj[good]))
    return root


def _links(radius: int):
    def out(codes: np.ndarray, roots: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), pa.array(roots.view(np.int64))], ["a", "b"])

    def solve(node: np.ndarray, codes: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.concatenate(([True], (node[1:] != node[:-1]).any(axis=1))))
        sizes = np.diff(np.append(starts, len(codes)))
        # Small nodes hold one leaf: their members are compared at each distance in the order.
        small = sizes <= LEAF
        member = np.repeat(np.arange(len(starts)), sizes)
        found = [np.empty((0, 2), np.uint64)]
        live = np.flatnonzero(np.repeat(small & (sizes > 1), sizes))
        for d in range(1, LEAF):
            live = live[(live + d < len(codes))]
            live = live[member[live] == member[live + d]]
            if not len(live):
                break
            near = live[np.bitwise_count(codes[live] ^ codes[live + d]) <= radius]
            found.append(np.stack([codes[near], codes[near + d]], axis=1))
        pairs = np.concatenate(found)
        if len(pairs):
            yield out(pairs[:, 0], pairs[:, 1])
        for k in np.flatnonzero(~small):
            own = codes[starts[k]:starts[k] + sizes[k]]
            root = links_below(own, radius)
            linked = np.flatnonzero(root != np.arange(len(own)))
            if len(linked):
                yield out(own[linked], own[root[linked]])

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, codes = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in rows:
            rank = batch.column(2).to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
            nodes = np.concatenate([nodes, np.stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()], axis=1)])
            codes = np.concatenate([codes, rank ^ (rank >> np.uint64(1))])
            if len(codes) < 1 << 15:
                continue
            last = np.flatnonzero((nodes != nodes[-1]).any(axis=1))
            cut = last[-1] + 1 if len(last) else 0  # the last node may go on in the next batch
            if cut:
                yield from solve(nodes[:cut], codes[:cut])
                nodes, codes = nodes[cut:], codes[cut:]
        if len(codes):
            yield from solve(nodes, codes)
    return run


def hamming_links(codes: DataFrame, radius: int = 4, node_limit: int = 20_000) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct codes ``(fp)`` within ``radius`` bits of each other."""
    rows, done = codes.select("fp", F.lit(0).cast("long").alias("mask")), []
    shape = "mask long, pattern long, rank long"
    for level in range(3):
        nodes = rows.mapInArrow(_upper_nodes(radius), shape)
        full = None
        if level < 2:
            full = staged(nodes.groupBy("mask", "pattern").agg(F.count("*").alias("n"))
                          .where(F.col("n") > node_limit).select("mask", "pattern"), "simhash-full-nodes")
            if full.isEmpty():
                full = None
        rest = nodes if full is None else nodes.join(full, ["mask", "pattern"], "left_anti")
        done.append(rest.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern", "rank")
                    .mapInArrow(_links(radius), "a long, b long"))
        if full is None:
            break
        unsigned = F.col("rank").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
        rows = staged(nodes.join(full, ["mask", "pattern"], "left_semi").select(
            unsigned.bitwiseXOR(F.shiftrightunsigned(unsigned, 1)).alias("fp"), "mask"), "simhash-full-rows")
    links = done[0]
    for more in done[1:]:
        links = links.union(more)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 4, radius: int = 4, node_limit: int = 20_000) -> DataFrame:
    """One row per input row: ``doc_id, text_key, fingerprint, component_id, root``.

    * fingerprint: 16 hex digits. Null, empty and blank texts: zero, linked like any other.
    * component_id: the smallest id reachable over links of at most ``radius``
      differing bits, itself included. A row with a null id gets the smallest
      id of its group, null if no row of the group has one.
    * root: a name of the group, a fingerprint as a signed long.
    * Repeated rows, and rows that share an id, are all returned. An empty
      table gives an empty result; other columns are ignored.
    """
    made = staged(fingerprints(docs, id_col, text_col, shingle_words), "simhash-fp")
    nodes = staged(made.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    stars = components(hamming_links(nodes, radius, node_limit), "simhash")
    rooted = staged(nodes.join(stars.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "least", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    linked = rooted.where("fp <> root").select("root").distinct()
    groups = (rooted.join(linked, "root", "left_semi").groupBy("root").agg(F.min("least").alias("group_least")))
    member = (rooted.join(groups, "root", "left")
              .select("fp", "root", F.coalesce("group_least", "least").alias("component_id")))
    return made.join(member, "fp").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 4,
                radius: int = 4) -> DataFrame:
    """``docs`` with all columns, one row of each group of near duplicates.

    The row with the smallest id stays (rows with a null id last; rows that
    share an id by a hash of the text); of rows with equal id and text, one.
    """
    found = staged(near_duplicates(docs, id_col, text_col, shingle_words, radius)
                   .groupBy("root", "doc_id", "text_key").agg(F.count("*").alias("n")), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "n"))
    # A group of one row needs no choice; the others name their rows to drop.
    groups = staged(found.groupBy("root").agg(first.alias("first"), F.sum("n").alias("rows")).where("rows > 1"), "simhash-groups")
    key = F.struct(F.col("doc_id").isNull(), "doc_id", "text_key", "n")
    of_id, of_key, own = free(docs, "__llm_id", "__llm_key", "__llm_hash")
    drop = (found.join(groups, "root").where(key != F.col("first"))
            .select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_key)))
    hashed = docs.withColumn(own, F.xxhash64(F.col(f"`{text_col}`")))
    same = hashed[f"`{id_col}`"].cast("long").eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_key))
    kept = hashed.join(drop, same, "left_anti")
    repeated = staged(groups.where("first.n > 1").select(F.col("first.doc_id").alias(of_id), F.col("first.text_key").alias(of_key)),
                      "simhash-repeated")
    if repeated.isEmpty():
        return kept.drop(own)
    once = kept.join(repeated, same, "left_semi").dropDuplicates([id_col, own])
    return kept.join(repeated, same, "left_anti").union(once).drop(own)
