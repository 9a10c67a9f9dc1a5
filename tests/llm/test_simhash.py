from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import simhash
from tests.llm.conftest import prose


def brute_fingerprint(text, k=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for blank in "\t\n\x0b\x0c\r":
        low = low.replace(blank, " ")
    words = [w for w in low.split(" ") if w]
    runs = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []
    h = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_groups(codes, radius):
    root = list(range(len(codes)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= radius:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(codes))]


def corpus():
    rng = random.Random(3)
    texts = [prose(rng, rng.randrange(1, 80)) for _ in range(60)]
    for t in texts[:25]:
        words = t.split()
        for _ in range(rng.randrange(1, 4)):
            changed = list(words)
            changed[rng.randrange(len(words))] = "x"
            texts.append(" ".join(changed))
    return texts + ["", None, " \n\t", "Ünï Code", "ÜNÏ code", "one", "a b c d", texts[0], texts[0].upper(), prose(rng, 30_000)]


def test_equals_brute_force(doc_frame):
    texts = corpus()
    got = {r.doc_id: r for r in simhash.near_duplicates(doc_frame(texts)).collect()}
    codes = [brute_fingerprint(t) for t in texts]
    groups = brute_groups(codes, 4)
    assert len(got) == len(texts)
    for i, code in enumerate(codes):
        assert got[i].fingerprint == f"{code:016x}"
        assert got[i].component_id == groups[i], i
    assert got[texts.index("")].fingerprint == "0" * 16


def test_spark_hash_is_the_same(spark):
    row = spark.sql("select xxhash64('wörd one two') h").first()
    assert row.h & (2**64 - 1) == xxhash.xxh64_intdigest("wörd one two".encode(), seed=42)


def clustered(rng, n):
    centres = [rng.getrandbits(64) for _ in range(n // 40 + 1)]
    codes = set()
    while len(codes) < n:
        c = rng.choice(centres)
        for _ in range(rng.randrange(7)):
            c ^= 1 << rng.randrange(64)
        codes.add(c)
    return sorted(codes)


def test_tree_under_one_node_links_all():
    rng = random.Random(4)
    for n in (1, 2, 17, 300, 1500):
        codes = np.array(clustered(rng, n), np.uint64)
        codes = codes[np.argsort(simhash.gray_rank(codes))]
        root = simhash.links_below(codes, 4)
        expected = brute_groups([int(c) for c in codes], 4)
        by_root = defaultdict(set)
        for i, r in enumerate(root):
            by_root[r].add(i)
        by_brute = defaultdict(set)
        for i, r in enumerate(expected):
            by_brute[r].add(i)
        assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_brute.values()))


def test_full_nodes_are_split_without_loss(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    codes = {base}
    while len(codes) < 400:  # one dense group: all its members share most patterns
        c = base
        for _ in range(rng.randrange(1, 12)):
            c ^= 1 << rng.randrange(64)
        codes.add(c)
    codes = sorted(codes)
    frame = spark.createDataFrame([(c - (1 << 64) if c >> 63 else c,) for c in codes], "fp long")
    stars = simhash.components(simhash.hamming_links(frame, 4, node_limit=20), "test")
    root = {r.node & (2**64 - 1): r.root & (2**64 - 1) for r in stars.collect()}
    groups = brute_groups(codes, 4)
    pairs = defaultdict(set)
    for i, g in enumerate(groups):
        pairs[g].add(root.get(codes[i], codes[i]))
    assert all(len(v) == 1 for v in pairs.values())
    assert len({root.get(c, c) for c in codes}) == len(set(groups))


def test_a_chain_gets_its_smallest_id(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges, "chain").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_nulls_repeats_and_empty_tables(spark, doc_frame):
    text = prose(random.Random(1), 50)
    rows = [(5, text), (5, text), (None, text), (None, "alone here"), (9, text + " x"), (5, "other words entirely")]
    got = simhash.near_duplicates(doc_frame(rows)).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id is None} <= {5, None}
    kept = simhash.one_of_each(doc_frame(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in kept) == sorted(
        [(False, 5, text), (False, 5, "other words entirely"), (True, 0, "alone here")])
    assert simhash.one_of_each(doc_frame(rows)).columns == doc_frame(rows).columns
    empty = doc_frame(rows).where(F.lit(False))
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0
