from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import packing

VOCABULARY, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def cut(docs, capacity):
    return packing.pieces(docs, VOCABULARY, RANKS, public_tokenizers.PATTERN, capacity)


def brute_pieces(texts, capacity):
    whole = Tokenizer.from_file(VOCABULARY)
    out = []
    for i, text in texts:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids), capacity), len(ids)]
        out += [(i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    return sorted(out, key=str)


def check_sequences(rows, capacity):
    """Sequences without gaps and within the capacity; returns how many."""
    at: dict[int, list] = {}
    for r in rows:
        at.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in at.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(at)


def texts_of_all_kinds():
    rng = random.Random(2)
    texts = [(i, " ".join(rng.choices(["alpha", "été", "日本", "1234", "\n\n", "don't", "<|endoftext|>"], k=rng.randrange(0, 60)))) for i in range(80)]
    return texts + [(None, None), (3, ""), (3, texts[3][1]), (3, texts[3][1]), (None, "null id"), (900, "long " * 30_000), (901, "a" * 50_000),
                    (902, "x <|endoftext|> y"), (903, "<|endoftext|"), (904, "\x85᠎\x1c 　 ok")]


def test_pieces_and_places(spark, doc_frame):
    texts = texts_of_all_kinds()
    found = packing.pack(cut(doc_frame(texts), 64), 64).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=str) == brute_pieces(texts, 64)
    n = check_sequences(found, 64)
    assert n <= packing.least_bins(dict(Counter(r.length for r in found)), 64) + 1


def test_empty_table(spark, doc_frame):
    assert packing.pack(cut(doc_frame([]), 64), 64).collect() == []


def naive_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fitting = [i for i, r in enumerate(rooms) if r >= s]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= s
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


def pieces_in(genome, capacity):
    held = Counter()
    for group, m in genome:
        assert m > 0 and sum(n * k for n, k in group) <= capacity
        for n, k in group:
            held[n] += k * m
    return held


@pytest.mark.parametrize("seed", range(30))
def test_best_fit_of_runs_is_best_fit_one_by_one(seed):
    rng = random.Random(seed)
    capacity = rng.choice([7, 10, 50, 100])
    sizes = [rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 120))]
    genome = packing.best_fit(dict(Counter(sizes)), capacity)
    assert sorted(r for g, m in genome for r in [capacity - sum(n * k for n, k in g)] * m) == naive_best_fit(sizes, capacity)
    people = packing.evolve([genome], dict(Counter(sizes)), capacity, 6, 5, rng)
    for g in people:
        assert pieces_in(g, capacity) == Counter(sizes)
    assert packing.least_bins(dict(Counter(sizes)), capacity) <= packing.bins_of(people[0]) <= packing.bins_of(genome)


def triplets(seed, n=40, capacity=1000):
    """Pieces that fill ``n`` bins by threes, which best fit does not find."""
    rng = random.Random(seed)
    sizes = []
    for _ in range(n):
        a = rng.randrange(380, 490)
        b = rng.randrange(255, (capacity - a) // 2 + 1)
        sizes += [a, b, capacity - a - b]
    return dict(Counter(sizes))


@pytest.mark.parametrize("seed", range(3))
def test_crossover_keeps_whole_bins_of_the_other_parent(seed):
    counts, rng = triplets(seed), random.Random(seed)
    a, b = packing.best_fit(counts, 1000), packing.best_fit(counts, 1000, (), sorted(counts, key=lambda n: rng.random()))
    child = packing.crossover(a, b, counts, 1000, rng)
    assert pieces_in(child, 1000) == Counter(counts)
    filled = sorted((Counter(dict(g)) for g, _ in b), key=lambda g: -sum(n * k for n, k in g.items()))
    held = [Counter(dict(g)) for g, _ in child]
    taken = [g for g in filled[:len(filled) // 2] if any(g <= h for h in held)]
    assert len(taken) >= len(filled) // 8


def test_islands_beat_best_fit(spark):
    counts = triplets(1)
    first = packing.bins_of(packing.best_fit(counts, 1000))
    df = spark.range(1)
    one = packing.packing(counts, df, 1000, islands=3, rounds=3, generations=15, population=8)
    again = packing.packing(counts, df, 1000, islands=3, rounds=3, generations=15, population=8)
    assert pieces_in(one, 1000) == Counter(counts)
    assert packing.bins_of(one) == packing.bins_of(again) < first


def test_a_worker_loads_its_vocabularies_once(spark, doc_frame, monkeypatch, tmp_path):
    """Many small tasks share what their worker loaded; without special strings no tokenizer is loaded."""
    rank_encoding, tokenizer, log = packing.rank_encoding, packing.tokenizer, str(tmp_path)

    def noted(kind, make):
        def run(*args):
            import os
            import uuid
            open(f"{log}/{kind}-{os.getpid()}-{uuid.uuid4().hex}", "w").close()
            return make(*args)
        return run
    monkeypatch.setattr(packing, "special_strings", lambda v: ["<|endoftext|>"])
    monkeypatch.setattr(packing, "rank_encoding", noted("ranks", rank_encoding))
    monkeypatch.setattr(packing, "tokenizer", noted("tokenizer", tokenizer))
    ranks = str(tmp_path / "own.tiktoken")          # a file of its own: no earlier test's worker knows it
    with open(RANKS, "rb") as f, open(ranks, "wb") as g:
        g.write(f.read())
    texts = [(i, f"text number {i}") for i in range(60)]
    docs = doc_frame(texts).repartition(30)
    found = packing.pieces(docs, VOCABULARY, ranks, public_tokenizers.PATTERN, 64).collect()
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found), key=str) == brute_pieces(texts, 64)
    loads = Counter(p.name.split("-")[1] for p in tmp_path.glob("ranks-*"))
    assert loads and set(loads.values()) == {1}
    assert not list(tmp_path.glob("tokenizer-*"))
