from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import mixing
from tests.llm.conftest import prose


def brute_targets(sizes, weights=(5, 2, 1), total=1.5, most=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, free, left = {}, set(names), total * sum(sizes.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= most * sizes[s]]
        if not over:
            target.update({s: weight[s] * level for s in free})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            free.discard(s)
    return target


def test_word_count(spark):
    texts = ["", None, " ", "a", " a ", "a\tb\n", "\x0b\x0ca\r", "ä ö", "a  b", "  x"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r.n for r in df.orderBy("i").select(mixing.word_count(F.col("t")).alias("n")).collect()]
    assert got == [len((t or "").encode().split()) for t in texts]


def test_flight_keeps_totals():
    rng = np.random.default_rng(0)
    for _ in range(40):
        n = int(rng.integers(1, 300))
        p, size = rng.random(n), rng.integers(0, 1000, n)
        out = mixing.fly(p, size, 7)
        between = (out > 0) & (out < 1)
        assert between.sum() <= 2
        assert abs(out.sum() - p.sum()) < 1e-6
        assert abs((out * size).sum() - (p * size).sum()) < 1e-4
        landed = mixing.land(out, size, float((p * size).sum()))
        assert set(np.unique(landed)) <= {0.0, 1.0}


def test_mix_meets_targets_and_reruns_agree(spark, doc_frame):
    rng = random.Random(6)
    texts = [prose(rng, rng.randrange(0, 60)) for _ in range(900)] + [None, "", " \n"] + [prose(rng, 900)]
    sources = [None if rng.random() < .1 else rng.choice(["a", "b", "Z", "é", "b", "b", "b"]) for _ in texts]
    docs = doc_frame(texts, sources)
    rows = mixing.mix(docs, block_rows=64).collect()
    assert [f for f in rows[0].asDict()] == ["doc_id", "size", "source_size", "target", "taken"]
    again = mixing.mix(docs.repartition(7), block_rows=64).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert len(rows) == len(texts)
    source = dict(enumerate(sources))
    sizes, taken = defaultdict(int), defaultdict(int)
    for i, t in enumerate(texts):
        sizes[sources[i]] += len((t or "").encode().split())
    targets = brute_targets(sizes)
    for r in rows:
        s = source[r.doc_id]
        assert r.size == len((texts[r.doc_id] or "").encode().split())
        assert r.source_size == sizes[s]
        assert abs(r.target - targets[s]) < 1e-6 * max(1, targets[s])
        assert 0 <= r.taken <= 2 * r.size
        if r.size:
            assert r.taken // r.size in (int(r.target / r.source_size + 1e-9), int(r.target / r.source_size + 1e-9) + 1)
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - targets[s]) <= 40, s


def test_repeated_rows_and_empty_tables(doc_frame):
    text = "one two three"
    rows = [(1, text)] * 500 + [(None, text)] * 20 + [(2, prose(random.Random(1), 40))] * 3
    got = mixing.mix(doc_frame(rows, ["s"] * 400 + [None] * 123), block_rows=16).collect()
    assert len(got) == len(rows)
    assert abs(sum(r.taken for r in got) - 1.5 * sum(r.size for r in got)) <= 20
    assert mixing.mix(doc_frame(rows).where(F.lit(False))).count() == 0
    blank = mixing.mix(doc_frame(["", None, " "])).collect()
    assert [(r.size, r.taken) for r in blank] == [(0, 0)] * 3


def reachable(sizes, base, goal):
    """The words nearest to ``goal`` that whole copies can give: each document base or base + 1 times."""
    sums = 1
    for n in sizes:
        sums |= sums << n
    start = base * sum(sizes)
    low, high, k = None, None, int(goal) - start
    for d in range(sum(sizes) + 1):
        if low is None and k - d >= 0 and sums >> (k - d) & 1:
            low = start + k - d
        if high is None and k + d >= 0 and sums >> (k + d) & 1:
            high = start + k + d
        if low is not None and high is not None:
            break
    return min((x for x in (low, high) if x is not None), key=lambda x: abs(x - goal))


def test_words_taken_come_within_a_few_of_what_is_reachable(doc_frame):
    rng = random.Random(11)
    lengths = {"a": [rng.randrange(1, 400) for _ in range(120)], "b": [rng.randrange(50, 900) for _ in range(12)],
               "c": [rng.randrange(20, 300) for _ in range(60)] + [9_000], "d": [rng.randrange(1, 50) for _ in range(500)], "e": [700]}
    texts, sources = zip(*[("w " * n, s) for s, own in lengths.items() for n in own])
    rows = mixing.mix(doc_frame(list(texts), list(sources))).collect()
    taken, target = defaultdict(int), {}
    for r in rows:
        taken[sources[r.doc_id]] += r.taken
        target[sources[r.doc_id]] = r.target
    for s, own in lengths.items():
        best = reachable(own, int(target[s] / sum(own) + 1e-9), target[s])
        assert abs(taken[s] - target[s]) <= abs(best - target[s]) + 3, s


def test_landing_by_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(60):
        n = int(rng.integers(1, 40))
        size = rng.integers(1, 500, n)
        p = rng.integers(0, 2, n).astype(float)
        p[rng.permutation(n)[:2]] = rng.random(min(n, 2))
        goal = float((p * size).sum())
        x = mixing.land(p, size, goal)
        assert set(np.unique(x)) <= {0.0, 1.0}
        if n <= 12:
            picks = (np.arange(1 << n)[:, None] >> np.arange(n)) & 1
            assert abs(abs((x * size).sum() - goal) - np.abs(picks @ size - goal).min()) < 1e-6
        elif n >= 25:
            assert abs((x * size).sum() - goal) <= 5
