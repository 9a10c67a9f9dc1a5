"""Helpers that several operators use: tables in the shared folder, words, components."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir


BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds: texts are long, and a task keeps a few batches in memory."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(str(spark.conf.get(name, "67108864")).rstrip("b") or 0) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the cluster's checkpoint folder and read it back.

    Cuts the lineage: a lost executor re-reads these files. Every call takes a
    new folder, so repeated or concurrent runs never touch each other's files.
    """
    spark = df.sparkSession
    small_batches(spark)
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/ledgerloom-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


WORKER_STORE = "ledgerloom_worker"


def kept_in_worker(name: Hashable, make: Callable[[], object]):
    """What ``make`` gives, made once in a Python worker and found by its later tasks.

    This package travels with each task by value, so its own globals are new
    every time; the store is a module of the worker's process.
    """
    held = vars(sys.modules.setdefault(WORKER_STORE, types.ModuleType(WORKER_STORE))).setdefault("held", {})
    if name not in held:
        held[name] = make()
    return held[name]


def free(df: DataFrame, *names: str) -> list[str]:
    """Each name, lengthened by ``_`` until it is no column of ``df`` (Spark does not tell cases apart)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def raw_bytes(column: pa.Array) -> list:
    """The UTF-8 bytes of each text of an Arrow column; None for null."""
    return column.cast(pa.binary()).to_pylist()


def lower_words(text: bytes | None) -> list[bytes]:
    """Words between runs of [\\x20\\x09-\\x0D], A-Z lower-cased, other characters untouched."""
    return text.lower().split() if text else []


def shingle_bytes(words: list[bytes], k: int) -> Iterator[bytes]:
    """Space-joined runs of ``k`` words, repeats included; fewer words: the whole sequence."""
    if len(words) <= k:
        return iter([b" ".join(words)] if words else [])
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    return map(joined.__getitem__, map(slice, starts[: len(words) - k + 1].tolist(), ends[k - 1:].tolist()))


def hash_all(items: Iterable[bytes], count: int = -1, seed: int = 42) -> np.ndarray:
    """XXH64 of each item, unsigned."""
    return np.fromiter(map(xxhash.xxh64_intdigest, items, repeat(seed)), np.uint64, count)


_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)


class WordHashes(dict):
    """XXH64 of words, remembered, as a task meets most words many times. Starts anew when large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1 << 17:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word, 42)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values whose output bits all depend on all input bits."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_shingles(words: list[bytes], k: int = 5, hashes: WordHashes | None = None) -> np.ndarray:
    """A 64-bit hash of every run of ``k`` (at most 5) words, made from one hash a word.

    Fewer words than ``k``: one hash of the whole sequence; none: no hash.
    """
    if not words:
        return np.empty(0, np.uint64)
    get = (WordHashes() if hashes is None else hashes).__getitem__
    h = np.fromiter(map(get, words), np.uint64, len(words))
    width = min(k, len(words))
    n = len(words) - width + 1
    total = h[:n] * np.uint64(_MULTIPLIERS[0] + width)
    for i in range(1, width):
        total += h[i:i + n] * np.uint64(_MULTIPLIERS[i])
    return mixed(total)


def components(edges: DataFrame, name: str) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: root is the smallest node reachable.

    Alternating large-star and small-star steps. Each keeps at most one row per
    edge, so a hub never multiplies; every step is written to the shared folder.
    """
    edges = staged(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), f"{name}-edges")
    before = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .where("a <> b").distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").select(F.explode(F.array(
            F.struct(F.col("a"), F.col("m").alias("b")),
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.*").where("a <> b").distinct())
        edges = staged(small, f"{name}-edges")
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now
