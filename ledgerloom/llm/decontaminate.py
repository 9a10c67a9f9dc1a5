"""Benchmark decontamination: SimHash of item-sized windows, looked up by Hamming blocks.

The items are taken in blocks of bounded size; each block's index goes to all
tasks, and every document is read against it. A window that is similar to an
item shares a shingle with it, so only windows around shingles of the block get
a fingerprint. The fingerprint is found by a multi-index: it is cut into 8
blocks of 8 bits, and an item within 23 bits differs by 2 bits or fewer in at
least one block, so looking up each block with up to 2 bits changed finds every
item within the radius. Those candidates are verified by their exact
weighted-shingle similarity: shared over united shingles, repeats counted.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import WordHashes, lower_words, mixed, raw_bytes, staged, word_shingles

BLOCKS = 8


class Items(NamedTuple):
    """The items of one length in words: ids, shingle hashes with counts, fingerprints and their multi-index."""

    words: int
    width: int
    ids: list[int]
    counts: list[Counter]
    codes: np.ndarray
    near: np.ndarray  # [block, byte] -> a bit for each item (in columns of 64) that is near in that block


class Index(NamedTuple):
    groups: list[Items]
    by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # filter, sorted shingles, group bits


def _code(ones: np.ndarray, n: np.ndarray | int) -> np.ndarray:
    """64-bit fingerprints from counts of set bits among ``n`` shingles."""
    bits = ones * 2 > np.asarray(n).reshape(-1, 1)
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(mixed(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def build_index(items: list[tuple[int, bytes]], shingle_words: int, radius: int) -> Index:
    """The index over ``(item_id, text)``; items without words match nothing and are left out."""
    by_length: dict[int, list] = {}
    for item_id, text in items:
        words = lower_words(text)
        if words:
            by_length.setdefault(len(words), []).append((item_id, word_shingles(words, shingle_words)))
    change = np.array([x for x in range(256) if x.bit_count() <= radius // BLOCKS], np.uint8)
    groups, shingles = [], {}
    for length, own in sorted(by_length.items()):
        width = min(length, shingle_words)
        codes = np.concatenate([_code(_bits(h).sum(axis=0, dtype=np.int64)[None], len(h)) for _, h in own])
        near = np.zeros((BLOCKS, 256, (len(own) + 63) // 64), np.uint64)
        for i, code in enumerate(codes.view(np.uint8).reshape(-1, BLOCKS)):
            for block in range(BLOCKS):
                near[block, code[block] ^ change, i // 64] |= np.uint64(1 << (i % 64))
        for _, h in own:
            for x in h.tolist():
                shingles.setdefault(width, {}).setdefault(x, set()).add(len(groups))
        groups.append(Items(length, width, [i for i, _ in own], [Counter(h.tolist()) for _, h in own], codes, near))
    by_width = {}
    for width, found in shingles.items():
        keys = np.array(sorted(found), np.uint64)
        known = np.zeros(1 << 20, bool)
        known[(keys >> np.uint64(44)).astype(np.int64)] = True
        member = np.empty(len(keys), object)
        member[:] = [sorted(found[k]) for k in keys.tolist()]
        by_width[width] = (known, keys, member)
    return Index(groups, by_width)


def _similarity(window: np.ndarray, item: Counter) -> float:
    own = Counter(window.tolist())
    shared = sum(min(n, item[x]) for x, n in own.items() if x in item)
    return shared / (len(window) + sum(item.values()) - shared)


def leaks(text: bytes | None, index: Index, least: float, radius: int,
          hashes: WordHashes | None = None) -> list[tuple[int, float, int, int, int]]:
    """``(item_id, similarity, first word, words, differing bits)`` of the best window for each item found.

    Items are told apart by their place in the index: ids may repeat or be null.
    """
    words = lower_words(text)
    best: dict[tuple[int, int], tuple] = {}
    for width, (known, keys, member) in index.by_width.items():
        if len(words) < width:
            continue
        h = word_shingles(words, width, hashes)
        maybe = np.flatnonzero(known[(h >> np.uint64(44)).astype(np.int64)])
        where = np.searchsorted(keys, h[maybe])
        hit = keys[np.minimum(where, len(keys) - 1)] == h[maybe]
        places: dict[int, list[int]] = {}
        for p, groups in zip(maybe[hit].tolist(), member[where[hit]]):
            for g in groups:
                places.setdefault(g, []).append(p)
        for g, at in places.items():
            for item, *found in _windows(h, len(words), np.array(at), index.groups[g], least, radius):
                if (g, item) not in best or found > best[g, item]:
                    best[g, item] = found
    return [(index.groups[g].ids[i], s, -start, n, -bits) for (g, i), (s, bits, start, n) in best.items()]


def _windows(h: np.ndarray, n_words: int, at: np.ndarray, items: Items, least: float, radius: int) -> Iterator[tuple]:
    """Windows as long as the items (or the whole text, if that is shorter) that hold one of the shingles ``at``."""
    span = min(items.words, n_words) - items.width + 1  # shingles in a window
    starts = np.unique(np.clip(at[:, None] - np.arange(span), 0, len(h) - span))
    for part in range(0, len(starts), 1 << 13):
        own = starts[part:part + (1 << 13)]
        low, high = int(own[0]), int(own[-1]) + span
        if high - low > 4 * len(own) + (1 << 15):  # scattered places: sum each window alone
            ones = np.stack([_bits(h[s:s + span]).sum(axis=0, dtype=np.int32) for s in own.tolist()])
        else:
            total = np.zeros((high - low + 1, 64), np.int32)
            np.cumsum(_bits(h[low:high]), axis=0, out=total[1:])
            ones = total[own - low + span] - total[own - low]
        codes = _code(ones, span)
        byte = codes.view(np.uint8).reshape(-1, BLOCKS)
        near = items.near[0][byte[:, 0]]
        for block in range(1, BLOCKS):
            near = near | items.near[block][byte[:, block]]
        for w in np.flatnonzero(near.any(axis=1)).tolist():
            bits = np.unpackbits(near[w].view(np.uint8), bitorder="little")
            for i in np.flatnonzero(bits).tolist():
                apart = int(np.bitwise_count(codes[w] ^ items.codes[i]))
                if apart <= radius:
                    s = int(own[w])
                    similar = _similarity(h[s:s + span], items.counts[i])
                    if similar >= least:
                        yield i, similar, -apart, -s, span + items.width - 1


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", shingle_words: int = 5,
                 least: float = 0.8, radius: int = 23, block_bytes: int = 4 << 20) -> DataFrame:
    """``(doc_id, item_id, similarity, start_word, n_words, distance)``: for each document and item
    the most similar window of at least ``least``.

    Words are split at [\\x20\\x09-\\x0D], A-Z lower-cased. An item shorter than
    ``shingle_words`` is one shingle, looked for at its own length; a document
    shorter than an item is one window. Null, empty and blank items and texts
    match nothing; of ties the window with the fewest differing bits, then the
    first, is given. Repeated rows and items are all reported; ids may be null;
    other columns are ignored. Items are read in blocks of about
    ``block_bytes``, so a benchmark of any size is searched whole.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    shape = "doc_id long, item_id long, similarity double, start_word long, n_words long, distance int"

    def against(index: Index):
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in rows:
                owner, found = [], []
                for i, text in enumerate(raw_bytes(batch.column(1))):
                    own = leaks(text, index, least, radius, hashes)
                    owner += [i] * len(own)
                    found += own
                if found:
                    item, similar, start, n, apart = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(owner, pa.int32())), pa.array(item, pa.int64()),
                         pa.array(similar, pa.float64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()),
                         pa.array(apart, pa.int32())],
                        ["doc_id", "item_id", "similarity", "start_word", "n_words", "distance"])
        return run

    result = None
    for index in _indexes(benchmark, item_col, item_text_col, shingle_words, radius, block_bytes):
        part = texts.mapInArrow(against(index), shape)
        result = part if result is None else result.union(part)
    return result


def _indexes(benchmark: DataFrame, item_col: str, text_col: str, shingle_words: int, radius: int,
             block_bytes: int) -> Iterator[Index]:
    """An index for each block of items; one at least."""
    if radius >= 3 * BLOCKS:
        raise ValueError(f"the blocks guarantee radii below {3 * BLOCKS}")
    items = staged(benchmark.select(F.col(f"`{item_col}`").cast("long").alias("item_id"),
                                    F.col(f"`{text_col}`").cast("string").alias("text"))
                   .where("text is not null"), "benchmark")
    total = items.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    count = max(1, math.ceil(total / block_bytes))
    for block in range(count):
        own = items if count == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == block)
        yield build_index([(r["item_id"], r["text"].encode()) for r in own.collect()], shingle_words, radius)


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", shingle_words: int = 5, least: float = 0.8, radius: int = 23,
                  block_bytes: int = 4 << 20) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window similar to an item."""
    place = docs.columns.index(text_col)

    def clean(index: Index):
        def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = WordHashes()
            for batch in rows:
                yield batch.filter(pa.array([not leaks(t, index, least, radius, hashes) for t in raw_bytes(batch.column(place))],
                                            pa.bool_()))
        return run

    for index in _indexes(benchmark, item_col, item_text_col, shingle_words, radius, block_bytes):
        docs = docs.mapInArrow(clean(index), docs.schema)
    return docs
