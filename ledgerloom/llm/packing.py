"""Best-fit packing of token sequences by a grouping genetic algorithm on islands.

Pieces of one length are interchangeable, so the corpus to pack is a count per
length, at most ``capacity`` of them however many documents there are. A bin is
the lengths it holds with their counts, and a genome is a list of bins, each
with the number of times it is used. Best fit places whole runs of equal
pieces at once, which gives the very bins that placing them one by one would.

Crossover injects well-filled bins of one parent whole into the other, takes
out every bin that would now hold a piece twice (more pieces of a length than
there are) and best-fits what was displaced. Islands evolve apart, one task
each; after a round the best genome of each moves on to the next island.

Pieces then take the places of the best genome by their rank among the pieces
of their length: no piece is shuffled for it and no task holds a bin's
documents.
"""

from __future__ import annotations

import pickle
import random
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import kept_in_worker, raw_bytes, small_batches, staged

Bin = tuple[tuple[int, int], ...]       # (length, count) pairs
Genome = list[tuple[Bin, int]]          # bins and how often each is used
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


# ------------------------------------------------------------------- pieces

def rank_encoding(ranks: str, pattern: str):
    """The encoding of a file of byte ranks and a splitting rule."""
    import base64

    import tiktoken
    with open(ranks, "rb") as f:
        table = {base64.b64decode(a): int(i) for a, i in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def tokenizer(vocabulary: str):
    """The tokenizer of a vocabulary file."""
    import os

    from tokenizers import Tokenizer
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Tokenizer.from_file(vocabulary)


def special_strings(vocabulary: str) -> list[str]:
    return [t.content for t in tokenizer(vocabulary).get_added_tokens_decoder().values()]


def pieces(docs: DataFrame, vocabulary: str, ranks: str, pattern: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Token pieces of every row: ids of the whole text, then ``end_id``, cut where longer than ``capacity``.

    ``vocabulary`` is a tokenizer file, ``ranks`` and ``pattern`` are the same
    vocabulary as byte ranks and its splitting rule: they give the same ids
    several times faster. Texts that hold one of the tokenizer's special strings
    are left to the tokenizer itself. A null or empty text is the end id alone.
    All but a text's first piece are full. Ids may be null or repeat; rows are
    kept apart. ``nth`` counts the pieces of a length in the part that wrote them.
    A worker loads the vocabularies once for all its tasks, the tokenizer only for a
    text that needs it.
    """
    small_batches(docs.sparkSession)
    special = special_strings(vocabulary)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        for b in batches:
            fast = kept_in_worker(("ranks", ranks, pattern), lambda: rank_encoding(ranks, pattern))
            rows: list[list] = [[] for _ in range(5)]
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                if any(s in text for s in special):
                    whole = kept_in_worker(("tokenizer", vocabulary), lambda: tokenizer(vocabulary))
                    ids = np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
                else:
                    ids = fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
                raw = np.append(ids, end_id).astype("<u4").tobytes()
                n = len(raw) // 4
                ends = range((n - 1) % capacity + 1, n + 1, capacity)
                start = 0
                for piece, end in enumerate(ends):
                    for col, v in zip(rows, (doc_id, piece, start, end - start, zlib.crc32(raw[4 * start:4 * end]))):
                        col.append(v)
                    start = end
            length = np.array(rows[3], np.int64)
            nth = np.empty(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            sizes, first, counts = np.unique(length[order], return_index=True, return_counts=True)
            nth[order] = np.arange(len(length)) - np.repeat(first, counts) + np.repeat(seen[sizes], counts)
            seen[sizes] += counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.int64()), pa.array(length),
                 pa.array(rows[4], pa.int64()), pa.array(np.full(len(length), part, np.int32)), pa.array(nth)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    return staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
                  .mapInArrow(cut, PIECES), "packing-pieces")


# ------------------------------------------------------------------ best fit

def best_fit(counts: dict[int, int], capacity: int, bins: Genome = (), order: Sequence[int] | None = None) -> Genome:
    """Place ``counts`` (length -> pieces) into ``bins`` and new ones: longest first (or in the
    ``order`` of lengths given), each into the fullest bin that has room."""
    open_bins: list[dict[Bin, int]] = [{} for _ in range(capacity + 1)]
    mask = 0                              # bit r: some bin has room r
    for b, m in bins:
        room = capacity - sum(n * k for n, k in b)
        open_bins[room][b] = open_bins[room].get(b, 0) + m
        mask |= 1 << room

    def put(b: Bin, m: int, room: int) -> None:
        nonlocal mask
        open_bins[room][b] = open_bins[room].get(b, 0) + m
        mask |= 1 << room

    for n in sorted(counts, reverse=True) if order is None else order:
        c = counts[n]
        while c:
            fitting = mask >> n
            if fitting:
                room = n + (fitting & -fitting).bit_length() - 1
                b, m = open_bins[room].popitem()
                if not open_bins[room]:
                    mask ^= 1 << room
            else:
                room, b, m = capacity, (), c
            each = room // n
            full = min(m, c // each)
            if full:
                put(b + ((n, each),), full, room - n * each)
                c -= full * each
            if m > full and c and c < each:
                put(b + ((n, c),), 1, room - n * c)
                m, c = m - 1, 0
            if b and m > full:
                put(b, m - full, room)
    return [(b, m) for slot in open_bins for b, m in slot.items()]


def bins_of(genome: Genome) -> int:
    return sum(m for _, m in genome)


def fitness(genome: Genome, capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among as many, the more uneven their filling (it leaves room to merge)."""
    return -bins_of(genome), sum(m * (sum(n * k for n, k in b) / capacity) ** 2 for b, m in genome)


def least_bins(counts: dict[int, int], capacity: int) -> int:
    """No packing has fewer bins: by volume, or by lengths over a bound beside those that cannot join them.

    For each bound, pieces over ``capacity - bound`` and over half are alone or
    with shorter ones; what the middle ones leave must hold the rest from the bound up.
    """
    total = np.zeros(capacity + 2, np.int64)
    volume = np.zeros(capacity + 2, np.int64)
    for n, c in counts.items():
        total[n], volume[n] = c, n * c
    many, size = np.append(np.cumsum(total[::-1])[::-1], 0), np.append(np.cumsum(volume[::-1])[::-1], 0)
    half = capacity // 2 + 1
    best = -(-int(size[0]) // capacity)
    for bound in range(1, capacity // 2 + 1):
        alone = int(many[capacity - bound + 1])
        middle = int(many[half] - many[capacity - bound + 1])
        room = middle * capacity - int(size[half] - size[capacity - bound + 1])
        small = int(size[bound] - size[half])
        best = max(best, alone + middle + max(0, -(-(small - room) // capacity)))
    return best


# ------------------------------------------------------------------ genetics

def crossover(a: Genome, b: Genome, counts: dict[int, int], capacity: int, rng: random.Random) -> Genome:
    """Whole well-filled bins of ``b`` go into ``a``; bins that repeat pieces go out, the displaced are best-fitted."""
    left = dict(counts)
    child: Genome = []
    filled = sorted(b, key=lambda x: -sum(n * k for n, k in x[0]))[:-(-len(b) // 2)]
    for group, m in [x for x in filled if rng.random() < 0.5] or filled[:1]:
        child.append((group, m))
        for n, k in group:
            left[n] -= k * m
    return _refill(child, sorted(a, key=lambda x: -sum(n * k for n, k in x[0])), left, capacity)


def mutation(a: Genome, counts: dict[int, int], capacity: int, rng: random.Random) -> Genome:
    """The emptiest bins and some others are dissolved and their pieces placed anew in another order."""
    kept = sorted(a, key=lambda x: -sum(n * k for n, k in x[0]))
    kept = [x for x in kept[:max(1, len(kept) * 9 // 10)] if rng.random() < 0.9]
    lengths = sorted(counts, key=lambda n: -n * rng.uniform(0.8, 1.0))
    return _refill([], kept, dict(counts), capacity, lengths)


def _refill(child: Genome, others: Genome, left: dict[int, int], capacity: int, order: Sequence[int] | None = None) -> Genome:
    """``child`` with those of ``others`` that the pieces left allow, and the rest best-fitted."""
    for group, m in others:
        m = min(m, min(left[n] // k for n, k in group))
        if m > 0:
            child.append((group, m))
            for n, k in group:
                left[n] -= k * m
    left = {n: c for n, c in left.items() if c}
    return best_fit(left, capacity, child, None if order is None else [n for n in order if n in left])


def evolve(genomes: list[Genome], counts: dict[int, int], capacity: int, generations: int, population: int,
           rng: random.Random) -> list[Genome]:
    """A population after some generations, best first; stops once no packing can have fewer bins."""
    bound = least_bins(counts, capacity)
    lengths = list(counts)
    while len(genomes) < population:
        order = sorted(lengths, key=lambda n: -n * rng.uniform(0.7, 1.0))
        genomes = genomes + [best_fit(counts, capacity, (), order)]

    def worth(g):
        return fitness(g, capacity)
    genomes = sorted(genomes, key=worth, reverse=True)[:population]
    for _ in range(generations):
        if bins_of(genomes[0]) == bound:
            break
        young = []
        for _ in range(population):
            a, b = (max(rng.sample(genomes, min(2, len(genomes))), key=worth) for _ in range(2))
            child = crossover(a, b, counts, capacity, rng)
            young.append(mutation(child, counts, capacity, rng) if rng.random() < 0.3 else child)
        genomes = sorted(genomes + young, key=worth, reverse=True)[:population]
    return genomes


def packing(counts: dict[int, int], df: DataFrame, capacity: int, islands: int, rounds: int, generations: int,
            population: int) -> Genome:
    """The best genome of all islands, from best fit and ``rounds`` of evolution with migration between."""
    spark = df.sparkSession
    best = best_fit(counts, capacity)
    bound = least_bins(counts, capacity)
    if bins_of(best) == bound:
        return best
    people = spark.createDataFrame([(i, 0, bytearray(pickle.dumps(best))) for i in range(islands)],
                                   "island int, place int, genome binary")
    for turn in range(rounds):
        def live(rows: Iterator[pa.RecordBatch], turn: int = turn) -> Iterator[pa.RecordBatch]:
            homes: dict[int, list[Genome]] = {}
            for b in rows:
                for island, genome in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                    homes.setdefault(island, []).append(pickle.loads(genome))
            for island, genomes in homes.items():
                new = evolve(genomes, counts, capacity, generations, population, random.Random(f"{turn}-{island}"))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([island] * len(new), pa.int32()), pa.array(range(len(new)), pa.int32()),
                     pa.array([-bins_of(g) for g in new], pa.int64()), pa.array([pickle.dumps(g) for g in new], pa.binary())],
                    ["island", "place", "worth", "genome"])

        grown = staged(people.repartition(islands, "island").mapInArrow(
            live, "island int, place int, worth long, genome binary"), "packing-islands")
        top = grown.orderBy(F.desc("worth"), "island", "place").select("worth", "genome").first()
        if -top["worth"] < bins_of(best):
            best = pickle.loads(top["genome"])
        if bins_of(best) == bound:
            break
        # The best of an island moves on to the next one.
        moved = grown.where("place = 0").withColumn("island", (F.col("island") + 1) % islands)
        people = grown.union(moved).select("island", "place", "genome")
    return best


# ---------------------------------------------------------------- placement

def pack(found: DataFrame, capacity: int = 2048, islands: int = 4, rounds: int = 3, generations: int = 4,
         population: int = 4) -> DataFrame:
    """``found`` (see ``pieces``) with the ``sequence_id`` and ``offset`` of every piece.

    A sequence holds at most ``capacity`` tokens, without gaps. No rows: no rows.
    """
    here = found.groupBy("part", "length").agg((F.max("nth") + 1).alias("n"))
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shares = staged(here.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "packing-shares")
    counts = {r["length"]: r["n"] for r in shares.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # one row a length
    genome = packing(counts, found, capacity, islands, rounds, generations, population) if counts else []
    slots, taken, first = [], dict.fromkeys(counts, 0), 0
    for group, m in genome:
        offset = 0
        for n, k in group:
            slots.append((n, taken[n], first, k, offset))
            taken[n] += k * m
            offset += n * k
        first += m
    slots.sort()
    n_, from_, first_, k_, offset_ = (np.array(x, np.int64) for x in zip(*slots)) if slots else [np.empty(0, np.int64)] * 5
    step = np.int64(sum(counts.values()) + 1)
    keys = n_ * step + from_

    def place(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.searchsorted(keys, length * step + rank, side="right") - 1
            nth = rank - from_[at]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(first_[at] + nth // k_[at]), pa.array(offset_[at] + nth % k_[at] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranks: Column = F.col("nth") + F.col("before")
    return (found.join(shares.select("part", "length", "before"), ["part", "length"])
            .select("doc_id", "piece", "start", "length", "ids_crc32", ranks.alias("rank"))
            .mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"))
