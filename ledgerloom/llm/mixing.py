"""Mixing sources to target weights by the cube method.

A source's target over its size is the number of copies a document should get.
The whole part is certain; the rest is an inclusion probability. The cube
method moves the vector of these probabilities, three documents at a time,
along the null space of two constraints, the document total and the word
total, until each is 0 or 1. What a block cannot settle (at most two documents)
flies again in the next round with the leftovers of other blocks, so only one
small landing problem of at most two documents a source remains. It is settled
by a bounded search: entries of the last block are turned, up to three at a
time, while that brings the words taken nearer to the target.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged
from ledgerloom.operators.keys import assign_dense_keys

TINY = 1e-9
TRIPLES = 128
FEW = 14
HEAVY, FAR = 4, 0.002


def word_count(text):
    """The number of [^\\x20\\x09-\\x0D]+ in a text; null: 0."""
    parts = F.split(text, "[\\x20\\x09-\\x0D]+")
    blank = F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
    # A run of blanks at an end leaves an empty part; a blank text leaves two, an empty one a single one.
    tail = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.when(text.isNull(), 0).otherwise(F.size(parts) - blank - tail).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = (5.0, 2.0, 1.0), total: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """``(source, rank, docs, source_size, target)``.

    ``sizes`` has (source, size). Sources by code point, null last, take the
    weights in turn and share ``total`` times all words by weight; a target
    stops at ``most`` times the source's words, and the excess is shared again
    by weight among the others until none is above.
    """
    grouped = staged(sizes.groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("source_size")),
                     "mix-sources")
    # Distributed row numbers: the sources of a crawl can be many.
    ranked = staged(assign_dense_keys(grouped, "rank", [F.col("source").asc_nulls_last()])
                    .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)),
                                                       ((F.col("rank") - 1) % len(weights) + 1).cast("int"))), "mix-ranked")
    cap = F.col("source_size") * F.lit(float(most))
    whole = (ranked.agg(F.sum("source_size")).first()[0] or 0) * float(total)
    level, below = None, None
    while True:  # each pass caps at least one more source, or ends
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= cap
        free, taken, count = ranked.agg(F.sum(F.when(~full, F.col("weight"))), F.sum(F.when(full, cap)),
                                        F.count(F.when(full, 1))).first()
        if count == below or not free:
            break
        below, level = count, (whole - (taken or 0.0)) / free
    target = cap if level is None else F.least(cap, F.col("weight") * F.lit(level))
    return ranked.select("source", "rank", "docs", "source_size", target.cast("double").alias("target"))


def fly(p: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Move p to 0 or 1 with its sum and its sum over sizes unchanged; at most two entries stay between."""
    p, draw = p.copy(), np.random.default_rng(seed).random(len(p) + 1)
    live, at, step = [], 0, 0
    while True:
        while len(live) < 3 and at < len(p):
            if TINY < p[at] < 1 - TINY:
                live.append(at)
            at += 1
        if len(live) < 2:
            return p
        if len(live) == 2:
            if size[live[0]] != size[live[1]]:
                return p
            null = (1.0, -1.0)
        else:
            a, b, c = (float(size[i]) for i in live)
            null = (b - c, c - a, a - b) if not a == b == c else (1.0, -1.0, 0.0)
        up = min((1 - p[i]) / u if u > 0 else p[i] / -u for i, u in zip(live, null) if u)
        down = min(p[i] / u if u > 0 else (1 - p[i]) / -u for i, u in zip(live, null) if u)
        move = up if draw[step % len(draw)] * (up + down) < down else -down
        step += 1
        for i, u in zip(live, null):
            p[i] += move * u
            if p[i] < TINY or p[i] > 1 - TINY:
                p[i] = round(p[i])
        live = [i for i in live if 0 < p[i] < 1]


def land(p: np.ndarray, size: np.ndarray, goal: float) -> np.ndarray:
    """Settle the last two entries or fewer so that the words taken come nearest to ``goal``, then turn
    up to three entries at a time while that brings them nearer. Of few entries all choices are tried."""
    if len(p) <= FEW:
        picks = (np.arange(1 << len(p))[:, None] >> np.arange(len(p))) & 1
        return picks[int(np.abs(picks @ size - goal).argmin())].astype(float)
    left = np.flatnonzero((p > 0) & (p < 1))
    x, off = None, None
    for pick in range(1 << len(left)):
        y = p.copy()
        y[left] = [pick >> k & 1 for k in range(len(left))]
        miss = abs(float((y * size).sum()) - goal)
        if off is None or miss < off - 0.5:
            x, off = y, miss
    x, off = _climb(x, size, goal)
    if off > FAR * goal:
        # One document that outweighs the rest may have to change sides, and the others with it.
        by_size = np.argsort(-size, kind="stable")
        heavy, light = by_size[:HEAVY], by_size[HEAVY:]
        for pick in range(1 << len(heavy)):
            y = np.zeros(len(p))
            y[heavy] = [pick >> k & 1 for k in range(len(heavy))]
            room = goal - float((y * size).sum())
            for i in light.tolist():
                if size[i] <= room:
                    y[i], room = 1, room - size[i]
            y, miss = _climb(y, size, goal)
            if miss < off - 0.5:
                x, off = y, miss
    return x


def _climb(x: np.ndarray, size: np.ndarray, goal: float) -> tuple[np.ndarray, float]:
    """Turn up to three entries at a time while that brings the words nearer to ``goal``."""
    off = abs(float((x * size).sum()) - goal)
    while off >= 0.5:
        best, turned = _turns(np.where(x == 1, -size, size).astype(np.int64), float((x * size).sum()) - goal)
        if best >= off - 0.5:
            break
        x[turned] = 1 - x[turned]
        off = best
    return x, off


def _turns(change: np.ndarray, miss: float) -> tuple[float, list[int]]:
    """The one, two or three entries whose changes together come nearest to undoing ``miss``.

    All singles and pairs are looked at; triples of a pair among ``TRIPLES`` entries,
    spread over the sizes, with any third.
    """
    order = np.argsort(change, kind="stable")
    ranked = change[order]
    n = len(ranked)

    def nearest(wanted: np.ndarray, barred: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """For each wanted change the position of the nearest one that is not barred, and how far off it is."""
        at = np.searchsorted(ranked, wanted)
        where, off = np.zeros(len(wanted), np.int64), np.full(len(wanted), np.inf)
        for step in range(-len(barred) - 1, len(barred) + 1):
            k = at + step
            ok = (k >= 0) & (k < n)
            for other in barred:
                ok &= k != other
            gap = np.where(ok, np.abs(ranked[np.clip(k, 0, n - 1)] - wanted), np.inf)
            better = gap < off
            where[better], off[better] = k[better], gap[better]
        return where, off

    own = np.arange(n)
    one, off1 = nearest(np.array([-miss]), [])
    found = [(float(off1[0]), [int(one[0])])]
    if n > 1:
        two, off2 = nearest(-miss - ranked, [own])
        i = int(off2.argmin())
        found.append((float(off2[i]), [i, int(two[i])]))
    if n > 2:
        few = np.unique(np.linspace(0, n - 1, min(n, TRIPLES)).astype(np.int64))
        a, b = (few[k] for k in np.triu_indices(len(few), 1))
        three, off3 = nearest(-miss - ranked[a] - ranked[b], [a, b])
        i = int(off3.argmin())
        found.append((float(off3[i]), [int(a[i]), int(b[i]), int(three[i])]))
    best = min(found, key=lambda f: (f[0] // 0.5, len(f[1])))
    return best[0], order[best[1]].tolist()


def _round(number: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["order", "doc_id", "size"], kind="stable", na_position="first")
        size = block["size"].to_numpy()
        seed = [number, int(block["rank"].iloc[0]), int(block["block"].iloc[0])]
        goal = float((block["p"].to_numpy() * size).sum())
        p = fly(block["p"].to_numpy(), size, seed)
        if int(block["blocks"].iloc[0]) == 1:
            p = land(p, size, goal)
        return block.assign(p=p)[["rank", "doc_id", "size", "copies", "base", "p"]]
    return run


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple = (5.0, 2.0, 1.0), total: float = 1.5, most: float = 2.0,
        block_rows: int = 2048) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per input row.

    ``taken`` is ``size`` times the whole copies the mix takes: the floor or the
    ceiling of target / source_size. Null and blank texts have size 0 and take
    nothing; a null source is a source of its own, last in the order; repeated
    rows, and rows with one id, source and size, are interchangeable and handled
    as one entry with a count. Ids may be null. Reruns agree: blocks and draws
    depend on the rows alone, not on how they are partitioned.
    """
    text = F.col(f"`{text_col}`").cast("string")
    sized = staged(docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                               F.col(f"`{source_col}`").cast("string").alias("source"),
                               word_count(text).alias("size")), "mix-sizes")
    targets = staged(source_targets(sized, weights, total, most), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    base = F.floor(ratio + F.lit(TINY))
    entries = (sized.groupBy("source", "doc_id", "size").agg(F.count("*").alias("copies")))
    entries = (entries.join(targets, entries["source"].eqNullSafe(targets["source"]))
               .withColumn("whole", base * F.col("copies"))
               # Equal rows: their shares add up to certain picks and one fraction.
               .withColumn("share", F.greatest((ratio - base) * F.col("copies"), F.lit(0.0)))
               .withColumn("sure", F.floor(F.col("share") + F.lit(TINY)))
               .select("rank", "doc_id", "size", "copies", (F.col("whole") + F.col("sure")).alias("base"),
                       F.greatest(F.col("share") - F.col("sure"), F.lit(0.0)).alias("p")))
    done, number = [], 0
    todo = staged(entries, "mix-round")
    while True:
        between = (F.col("p") > TINY) & (F.col("p") < 1 - TINY) & (F.col("size") > 0)
        done.append(todo.where(~between).withColumn("p", F.round("p")))
        todo = todo.where(between)
        counts = staged(todo.groupBy("rank").agg(F.ceil(F.count("*") / F.lit(block_rows)).alias("blocks")), "mix-counts")
        largest = counts.agg(F.max("blocks")).first()[0]
        if not largest:
            break
        order = F.xxhash64(F.lit(number), "doc_id", "size")
        dealt = (todo.join(counts, "rank").withColumn("order", order)
                 .withColumn("block", F.pmod(F.shiftright("order", 8), F.col("blocks"))))
        flown = dealt.groupBy("rank", "block").applyInPandas(
            _round(number), "rank long, doc_id long, size long, copies long, base long, p double")
        todo, number = staged(flown, "mix-round"), number + 1
    settled = done[0]
    for more in done[1:]:
        settled = settled.union(more)
    picks = F.col("base") + F.col("p").cast("long")
    rows = settled.select("rank", "doc_id", "size", "copies", picks.alias("picks")).withColumn(
        "nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    taken = (F.floor(F.col("picks") / F.col("copies"))
             + F.when(F.col("nth") <= F.col("picks") % F.col("copies"), 1).otherwise(0)) * F.col("size")
    return (rows.select("rank", "doc_id", "size", taken.cast("long").alias("taken")).join(targets, "rank")
            .select("doc_id", "size", "source_size", "target", "taken"))
