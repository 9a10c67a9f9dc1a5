"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that also starts elsewhere.

A suffix array of the whole corpus would not distribute, so its work is cut to
places that can matter and grouped so that equal strings meet:

1. Anchors. In every window of ``length`` bytes the ``seed_bytes``-byte string
   with the least hash is an anchor (all ties are). Equal windows have equal
   anchors at equal offsets, so a repeated window has an anchor whose hash
   occurs at least twice. An anchor's segment is all windows that hold it, and
   no earlier anchor of the same hash, so a place lies in one segment a hash.
2. Segments under one anchor hash form a group. Equal segments are counted
   once; a segment found twice is removed whole. Groups with different segments
   are suffix-sorted (``suffix_sort``); equal windows are neighbours in the
   order, and neighbours that agree on ``length`` bytes, compared byte by byte,
   are repeated.
3. A group of more than ``group_limit`` segments is split: one half of its
   window offsets each, under the bytes that all windows of a half share. After
   at most log2(windows) splits a group holds equal windows only, so no group
   is ever collected whole, however many copies a passage has.
4. The repeated ranges go back to their documents and are cut there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import mixed, raw_bytes, staged
from ledgerloom.llm.suffix_sort import suffix_arrays

CHUNK = 1 << 20
BATCH = 1 << 20         # bytes of groups that are sorted in one go
HELD = 8 * BATCH        # bytes of groups that are put in order of size first
_BASE = 0x9E3779B97F4A7C15 | 1
_RANGES = "key long, sid_a long, sid_b long, at int, upto int"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Anchors:
    """Finds a text's anchors; holds the tables that the rolling hash needs."""

    def __init__(self, length: int, seed_bytes: int):
        self.length, self.seed = length, seed_bytes
        self.windows = length - seed_bytes + 1
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self.symbol = mixed(np.arange(1, 257, dtype=np.uint64))

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of every run of ``seed_bytes`` bytes, from wrapped prefix sums."""
        if len(self.up) <= len(data):
            self.up = _powers(_BASE, len(data) + 1)
            self.down = _powers(pow(_BASE, -1, 1 << 64), len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.symbol[data] * self.down[:len(data)], out=total[1:])
        n = len(data) - self.seed + 1
        return mixed((total[self.seed:] - total[:-self.seed]) * self.up[:n])

    @staticmethod
    def _slide(values: np.ndarray, width: int, least: bool) -> np.ndarray:
        pick, done = (np.minimum if least else np.maximum), 1
        while done < width:
            step = min(done, width - done)
            values = pick(values[:len(values) - step], values[step:])
            done += step
        return values

    def find(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors, in order."""
        places, hashes = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        data, w = np.frombuffer(text, np.uint8), self.windows
        # Pieces overlap, so that each anchor is judged by all windows that hold it.
        for at in range(0, max(0, len(data) - self.length + 1), CHUNK):
            low, high = max(0, at - w + 1), min(len(data), at + CHUNK + self.length + w)
            h = self._hashes(data[low:high])
            least = self._slide(h, w, True)
            pad = np.zeros(w - 1, np.uint64)
            best = self._slide(np.concatenate([pad, least, pad]), w, False)
            found = np.flatnonzero(best == h) + low
            # The piece answers for its own places; the last one also for those behind them.
            last = at + CHUNK >= len(data) - self.length + 1
            found = found[(found >= at) & ((found < at + CHUNK) | last)]
            places.append(found)
            hashes.append(h[found - low])
        return np.concatenate(places), np.concatenate(hashes)


def _identity(id_col: str, text_col: str) -> list[Column]:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return [F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text")]


def _scan(length: int, seed_bytes: int):
    """Rows (key, doc_id, text_key, place, low, upto): an anchor and where its segment begins, or
    with upto a range known to be repeated."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, w = Anchors(length, seed_bytes), length - seed_bytes + 1
        for batch in rows:
            keys, owners, places, lows, ends = [], [], [], [], []
            for i, text in enumerate(raw_bytes(batch.column(2))):
                if len(text) < length:
                    continue
                at, h = finder.find(text)
                end = np.zeros(len(at), np.int64)
                by_key = np.lexsort((at, h))
                before = np.full(len(at), -1, np.int64)
                again = np.flatnonzero(h[by_key[1:]] == h[by_key[:-1]])
                before[by_key[again + 1]] = at[by_key[again]]
                low = np.maximum(np.maximum(at - w, before) + 1, 0)
                # A text that repeats itself in steps, such as a run of blanks: neighbours with the
                # same whole segment prove each other repeated, and one stands for both.
                close = np.flatnonzero((h[1:] == h[:-1]) & (np.diff(at) < w)) + 1
                if len(close):
                    keep = np.ones(len(at), bool)
                    proven: list[list[int]] = []
                    for j in close.tolist():
                        a, b = int(at[j - 1]) - w + 1, int(at[j]) - w + 1
                        size = seed_bytes + 2 * (w - 1)
                        if a >= 0 and b + size <= len(text) and text[a:a + size] == text[b:b + size]:
                            keep[j] = False
                            if proven and a <= proven[-1][1]:
                                proven[-1][1] = b + size
                            else:
                                proven.append([a, b + size])
                    at, h, end, low = at[keep], h[keep], end[keep], low[keep]
                whole = low + length <= len(text)  # else each of its windows lies in an earlier anchor's segment
                at, h, end, low = at[whole], h[whole], end[whole], low[whole]
                if len(close):
                    if proven:
                        at = np.concatenate([at, [x for x, _ in proven]])
                        end = np.concatenate([end, [y for _, y in proven]])
                        h = np.concatenate([h, np.zeros(len(proven), np.uint64)])
                        low = np.concatenate([low, np.zeros(len(proven), np.int64)])
                keys.append(h)
                places.append(at)
                lows.append(low)
                ends.append(end)
                owners.append(np.full(len(at), i))
            if keys:
                owner = pa.array(np.concatenate(owners).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), batch.column(0).take(owner), batch.column(1).take(owner),
                     *(pa.array(np.concatenate(x).astype(np.int32)) for x in (places, lows, ends))],
                    ["key", "doc_id", "text_key", "place", "low", "upto"])
    return run


def _segments(length: int, with_data: bool):
    """From (doc_id, text_key, text, keys, places, lows): each anchor's segment, by name or with its bytes."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out_key, names, owners, starts, offsets, data = [], [], [], [], [], []

            def made() -> pa.RecordBatch:
                pair = np.frombuffer(b"".join(names), "<i8").reshape(-1, 2)
                columns = [pa.array(out_key, pa.int64()), pa.array(pair[:, 0]), pa.array(pair[:, 1])]
                if with_data:
                    return pa.RecordBatch.from_arrays([*columns, pa.array(offsets, pa.int32()), pa.array(data, pa.binary())],
                                                      ["key", "sid_a", "sid_b", "off", "data"])
                own = pa.array(owners, pa.int32())
                return pa.RecordBatch.from_arrays([*columns, batch.column(0).take(own), batch.column(1).take(own),
                                                   pa.array(starts, pa.int32()), pa.array(offsets, pa.int32())],
                                                  ["key", "sid_a", "sid_b", "doc_id", "text_key", "start", "size"])

            held = 0
            for i, (text, keys, places, lows) in enumerate(zip(raw_bytes(batch.column(2)),
                                                               *(batch.column(k).to_pylist() for k in (3, 4, 5)))):
                for key, at, low in zip(keys, places, lows):
                    segment = text[low:at + length]
                    # The anchor's offset is part of the name: cut segments keep their alignment.
                    names.append(xxhash.xxh3_128_digest(segment, at - low))
                    out_key.append(key)
                    owners.append(i)
                    starts.append(low)
                    if with_data:
                        offsets.append(at - low)
                        data.append(segment)
                        held += len(segment)
                        if held > 1 << 24:
                            yield made()
                            out_key, names, owners, starts, offsets, data, held = [], [], [], [], [], [], 0
                    else:
                        offsets.append(len(segment))
            if out_key:
                yield made()
    return run


def repeated_windows(segments: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """For each group, for each of its different segments: the window starts that another place of the group repeats."""
    shapes = [[len(s) for s in group] for group in segments]
    parts, first, begin, total = [], [], [], 0
    for group in segments:
        first.append(total)
        for k, s in enumerate(group):
            begin.append(total)
            symbols = np.empty(len(s) + 1, np.int16)
            symbols[:-1] = np.frombuffer(s, np.uint8)
            symbols[:-1] += 2
            symbols[-1] = 0 if k == len(group) - 1 else 1
            parts.append(symbols)
            total += len(symbols)
    text = np.concatenate(parts)
    order = suffix_arrays(text, np.array(first))
    sizes = np.concatenate([np.array(x) for x in shapes])
    begin = np.array(begin)
    window = np.zeros(total + 1, np.int64)  # 1 where a whole window starts
    np.add.at(window, begin, 1)
    np.add.at(window, begin + sizes - length + 1, -1)
    window = np.cumsum(window)[:-1].astype(bool)
    group_of = np.zeros(total, np.int64)
    group_of[np.array(first)[1:]] = 1
    group_of = np.cumsum(group_of)
    a, b = order[:-1], order[1:]
    same = np.flatnonzero(window[a] & window[b] & (group_of[a] == group_of[b]))
    a, b = a[same], b[same]
    # Compare 8 bytes at a time, and go on only with pairs that agree so far.
    plain = np.zeros(total + 8, np.uint8)
    plain[:total] = (text - 2).astype(np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(plain, 8).copy().view(np.uint64).ravel()
    offsets = [*range(0, length - 7, 8)]
    if length % 8:
        offsets.append(length - 8)
    for off in sorted(offsets, reverse=True):  # far bytes tell neighbours apart first
        agree = words[a + off] == words[b + off]
        a, b = a[agree], b[agree]
    hit = np.zeros(total, bool)
    hit[a] = hit[b] = True
    out, k = [], 0
    for group in segments:
        own = []
        for s in group:
            own.append(np.flatnonzero(hit[begin[k]:begin[k] + len(s)]))
            k += 1
        out.append(own)
    return out


def covered(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """The maximal ranges that windows at the sorted ``starts`` cover."""
    if not len(starts):
        return []
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return list(zip(starts[np.append(0, gap + 1)].tolist(), (starts[np.append(gap, len(starts) - 1)] + length).tolist()))


def _in_doubt(group: list[tuple], length: int, seed_bytes: int) -> list[tuple]:
    """The segments of a group that can share a window with another one.

    Equal windows hold the group's anchor at the same offset, and of the bytes
    beside it half at least on one side. A segment whose anchor with that half
    before it, and with that half after it, is met in no other has no such window.
    """
    half = (length - seed_bytes) // 2
    sides: dict[tuple[int, bytes], int] = {}
    own = []
    for _, _, _, off, data in group:
        pair = []
        if off >= half:
            pair.append((0, data[off - half:off + seed_bytes]))
        if off + seed_bytes + half <= len(data):
            pair.append((1, data[off:off + seed_bytes + half]))
        own.append(pair)
        for side in pair:
            sides[side] = sides.get(side, 0) + 1
    return [row for row, pair in zip(group, own) if any(sides[side] > 1 for side in pair)]


def _sort_groups(length: int, seed_bytes: int):
    """Ranges of repeated bytes in the segments of each group, from rows (key, sid_a, sid_b, off, data) sorted by key."""
    def solve(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
        rows = [(*row[:3], low, high)
                for group, starts in zip(groups, repeated_windows([[r[4] for r in g] for g in groups], length))
                for row, own in zip(group, starts) for low, high in covered(own, length)]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64() if i < 3 else pa.int32()) for i, c in enumerate(zip(*rows))],
                ["key", "sid_a", "sid_b", "at", "upto"])

    def by_size(groups: list[list[tuple]]) -> Iterator[pa.RecordBatch]:
        # A go takes as many steps as its longest group has places: groups of like size share one.
        groups = [g for g in (_in_doubt(g, length, seed_bytes) for g in groups) if len(g) > 1]
        sizes = [sum(len(row[4]) + 1 for row in g) for g in groups]
        go, held = [], 0
        for i in sorted(range(len(groups)), key=sizes.__getitem__):
            if held and held + sizes[i] > BATCH:
                yield from solve(go)
                go, held = [], 0
            go.append(groups[i])
            held += sizes[i]
        if go:
            yield from solve(go)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, held = [], 0
        for batch in rows:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if not groups or groups[-1][-1][0] != row[0]:
                    if held > HELD:
                        yield from by_size(groups)
                        groups, held = [], 0
                    groups.append([])
                groups[-1].append(row)
                held += len(row[4]) + 1
        if groups:
            yield from by_size(groups)
    return run


_PARTS = ("parent long, parent_a long, parent_b long, shift int, key long, sid_a long, sid_b long, "
          "off int, data binary, low int, high int")


def _split(length: int):
    """Each segment (key, sid_a, sid_b, off, data, low, high) cut to the window offsets, relative to its
    anchor, of either half of [low, high]."""
    names = [f.split()[0] for f in _PARTS.split(", ")]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for key, a, b, off, data, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                middle = (low + high) // 2
                for x, y in ((low, middle), (middle + 1, high)):
                    begin, end = max(x, -off), min(y, len(data) - length - off)
                    if begin > end:
                        continue
                    piece = data[begin + off:end + off + length]
                    common = data[y + off:x + off + length]
                    name = np.frombuffer(xxhash.xxh3_128_digest(piece, 1000 - begin), "<i8")
                    head = np.frombuffer(xxhash.xxh64_digest(common + b"%d,%d" % (x, y), key & (2**64 - 1)), "<i8")
                    out.append((key, a, b, begin + off, int(head[0]), int(name[0]), int(name[1]), -begin, piece, x, y))
            if out:
                kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 3 + [pa.int32(), pa.binary(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    return run


def repeated_ranges(docs: DataFrame, length: int = 400, seed_bytes: int = 200, group_limit: int = 32
                    ) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_key, at, upto)`` ranges to remove, overlaps among them, and the texts
    ``(doc_id, text_key, text)`` they lie in. ``docs`` has doc_id, text_key, text."""
    who, sid = ["doc_id", "text_key"], ["key", "sid_a", "sid_b"]
    scanned = staged(docs.mapInArrow(_scan(length, seed_bytes), "key long, doc_id long, text_key long, place int, low int, upto int"),
                     "anchors")
    proven = scanned.where("upto > 0").select(*who, F.col("place").alias("at"), "upto")
    anchors = scanned.where("upto = 0")
    twice = anchors.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    live = (anchors.join(twice, "key", "left_semi").groupBy(*who)
            .agg(F.array_distinct(F.collect_list(F.struct("key", "place", "low"))).alias("a")))
    # Rows that share an id and a text are each read: their copies repeat each other.
    marked = live.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "a").unionByName(
        proven.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"),
                      F.array().cast("array<struct<key:long,place:int,low:int>>").alias("a")).distinct())
    marked = marked.groupBy("of_id", "of_key").agg(F.flatten(F.collect_list("a")).alias("a"))
    texts = staged(docs.join(marked.hint("shuffle_hash"), docs["doc_id"].eqNullSafe(F.col("of_id")) & (docs["text_key"] == F.col("of_key")))
                   .select(*who, "text", F.col("a.key").alias("keys"), F.col("a.place").alias("places"),
                           F.col("a.low").alias("lows")), "marked-texts")
    owners = staged(texts.mapInArrow(_segments(length, False),
                                     "key long, sid_a long, sid_b long, doc_id long, text_key long, start int, size int"),
                    "segments")
    counts = staged(owners.groupBy(*sid).agg(F.count("*").alias("n"), F.first("size").alias("size"),
                                             F.min(F.struct(F.col("doc_id"), F.col("text_key"), F.col("start"))).alias("one")),
                    "segment-counts")
    mixed_keys = counts.groupBy("key").agg(F.count("*").alias("different")).where("different > 1").select("key")
    # One place of each segment of a mixed group gives the bytes. (Rows that share an id and a text
    # give them twice; each of their segments is removed whole in any case.)
    asked = (counts.join(mixed_keys, "key", "left_semi").select("key", *sid[1:], "one.*")
             .groupBy(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"))
             .agg(F.collect_list(F.struct("key", *sid[1:])).alias("wanted")))
    bytes_of = (texts.join(asked.hint("shuffle_hash"),
                                               texts["doc_id"].eqNullSafe(F.col("of_id")) & (texts["text_key"] == F.col("of_key")))
                .select(*who, "text", "keys", "places", "lows", "wanted"))
    pieces = staged(_wanted(bytes_of, length), "pieces")
    found = []
    pieces = pieces.withColumns({"low": F.lit(seed_bytes - length), "high": F.lit(0)})
    counted = counts.select(*sid, "n", "size")
    while True:
        found.append((counted.where("n > 1").select(*sid, F.lit(0).alias("at"), F.col("size").alias("upto")), owners))
        per_key = pieces.groupBy("key").agg(F.count("*").alias("different"))
        large = staged(per_key.where(F.col("different") > group_limit).select("key"), "large-groups")
        small = pieces.join(large, "key", "left_anti").join(per_key.where("different > 1").select("key"), "key", "left_semi")
        sorted_ = staged(small.select(*sid, "off", "data").repartition("key").sortWithinPartitions(*sid)
                         .mapInArrow(_sort_groups(length, seed_bytes), _RANGES), "sorted-ranges")
        found.append((sorted_, owners))
        if large.isEmpty():
            break
        hot = pieces.join(large, "key", "left_semi").select(*sid, "off", "data", "low", "high")
        parts = staged(hot.mapInArrow(_split(length), _PARTS), "split-pieces")
        links = parts.select("parent", "parent_a", "parent_b", "shift", *sid, F.octet_length("data").alias("part_size"))
        owners = staged(owners.select(F.col("key").alias("parent"), F.col("sid_a").alias("parent_a"), F.col("sid_b").alias("parent_b"),
                                      *who, "start").join(links, ["parent", "parent_a", "parent_b"])
                        .select(*sid, *who, (F.col("start") + F.col("shift")).alias("start"), F.col("part_size").alias("size")),
                        "split-owners")
        counted = staged(owners.groupBy(*sid).agg(F.count("*").alias("n"), F.first("size").alias("size")), "split-counts")
        # Equal names mean equal bytes, so any of them serves.
        pieces = staged(parts.groupBy(*sid).agg(*[F.first(c).alias(c) for c in ("off", "data", "low", "high")]),
                        "split-distinct")
    ranges = proven
    for part, own in found:
        ranges = ranges.union(own.join(part, sid).select(*who, (F.col("start") + F.col("at")).alias("at"),
                                                         (F.col("start") + F.col("upto")).alias("upto")))
    return ranges, texts.select(*who, "text")


def _wanted(rows: DataFrame, length: int) -> DataFrame:
    """``(key, sid_a, sid_b, off, data)`` of the wanted segments of each text."""
    cut = _segments(length, True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                one = batch.slice(i, 1)
                wanted = {(w["key"], w["sid_a"], w["sid_b"]) for w in one.column(6)[0].as_py()}
                for made in cut(iter([one.select(range(6))])):
                    names = list(zip(*(made.column(k).to_pylist() for k in range(3))))
                    take = []
                    for k, name in enumerate(names):
                        if name in wanted:
                            wanted.discard(name)
                            take.append(k)
                    if take:
                        yield made.take(pa.array(take, pa.int32()))

    return rows.mapInArrow(run, "key long, sid_a long, sid_b long, off int, data binary")


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the ranges cover; ranges that touch make one run."""
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 400,
                    seed_bytes: int = 200, group_limit: int = 32) -> DataFrame:
    """``(doc_id, text_key, n_bytes, n_removed, spans, kept_sha256)``, one row per input row.

    ``spans`` are the maximal removed [start, end) byte ranges, null for none.
    Texts are UTF-8 bytes; null counts as empty, and texts shorter than
    ``length`` bytes lose nothing. Strings are judged on the input, over all
    rows: repeated rows, and rows that share an id, repeat each other. Ids may
    be null; an empty table gives no rows; other columns are ignored.
    """
    named = docs.select(*_identity(id_col, text_col))
    ranges, texts = repeated_ranges(named, length, seed_bytes, group_limit)
    of = (ranges.distinct().groupBy(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"))
          .agg(F.collect_list(F.struct("at", "upto")).alias("ranges")))
    shape = "doc_id long, text_key long, n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept_sha256 string"

    def cut(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in rows:
            sizes, gone, spans, hashes = [], [], [], []
            for text, own in zip(raw_bytes(batch.column(2)), batch.column(3).to_pylist()):
                runs = merged([(r["at"], r["upto"]) for r in own])
                kept, at = hashlib.sha256(), 0
                for a, b in runs:
                    kept.update(text[at:a])
                    at = b
                kept.update(text[at:])
                sizes.append(len(text))
                gone.append(sum(b - a for a, b in runs))
                spans.append([{"start": a, "end": b} for a, b in runs])
                hashes.append(kept.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, spans_type), pa.array(hashes)],
                ["doc_id", "text_key", "n_bytes", "n_removed", "spans", "kept_sha256"])

    same = texts["doc_id"].eqNullSafe(F.col("of_id")) & (texts["text_key"] == F.col("of_key"))
    changed = staged(texts.join(of.hint("shuffle_hash"), same).select("doc_id", "text_key", "text", "ranges").mapInArrow(cut, shape),
                     "cut-texts")
    done = changed.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key")).distinct()
    whole = named.select("doc_id", "text_key", F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
                         F.lit(None).cast("array<struct<start:long,end:long>>").alias("spans"), F.sha2("text", 256).alias("kept_sha256"))
    rest = whole.join(done, whole["doc_id"].eqNullSafe(F.col("of_id")) & (whole["text_key"] == F.col("of_key")), "left_anti")
    return changed.union(rest)
