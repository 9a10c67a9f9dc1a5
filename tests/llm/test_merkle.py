from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import merkle, sha256_lanes as sha


def field(v):
    return b"-" if v is None else b"%d:%b" % (len(str(v).encode()), str(v).encode())


def leaf_of(row):
    return hashlib.sha256(b"".join(map(field, row))).hexdigest()


def joined(run):
    return hashlib.sha256("".join(run).encode()).hexdigest()


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([joined(last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def climb(levels, i, cur):
    siblings = []
    for level in levels[:-1]:
        run, k = level[i // 3 * 3:i // 3 * 3 + 3], i % 3
        siblings += run[:k] + run[k + 1:]
        cur = joined(run[:k] + [cur] + run[k + 1:])
        i //= 3
    return siblings, cur


def brute(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        own = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees.append((own, levels_of([leaf_of(r) for r in own])))
    top = levels_of([t[-1][0] for _, t in trees])
    out = []
    for j, (own, levels) in enumerate(trees):
        for i, r in enumerate(own):
            cur = levels[0][i]
            if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                cur = leaf_of((*r[:4], r[4].replace("\n", "")))
            below, cur = climb(levels, i, cur)
            above, cur = climb(top, j, cur)
            out.append((r[0], levels[0][i], levels[-1][0], top[-1][0], joined(below + above), cur, cur == top[-1][0]))
    return sorted(out, key=str)


def run(docs):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = merkle.document_leaves(docs, tampered, lambda t: t.replace(b"\n", b""))
    return sorted(map(tuple, merkle.fold(merkle.manifest(leaves)).collect()), key=str)


def some_rows(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = rng.choice([None, "", "a\nb", "\n", "x " * rng.randrange(50), "é\nü" * 3])
        source = rng.choice([None, "", "hot", "hot", "hot", "é", "z", f"s{rng.randrange(5)}"])
        rows.append((rng.choice([i, i, i, None, 3]), source, rng.choice([None, "en"]), rng.choice([None, 7]), text))
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize("depth", [1, 2, 9])
def test_equals_brute_force(spark, monkeypatch, depth):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "SPAN", 3 ** depth)
    monkeypatch.setattr(merkle, "GROUPED_ROWS", 7)
    rows = some_rows(90) + [(5, "hot", "en", 1, "same\n")] * 4      # repeated rows are leaves of their own
    docs = spark.createDataFrame(rows, SCHEMA)
    assert run(docs) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 27, 28])
def test_one_tree_of_any_size(spark, monkeypatch, n):
    monkeypatch.setattr(merkle, "DEPTH", 2)
    monkeypatch.setattr(merkle, "SPAN", 9)
    rows = [(i, None, "en", i, f"line {i}\nend") for i in range(n)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == []


def test_very_long_text_and_clashing_columns(spark):
    rows = [(1, "s", "en", 2, "long\n" * 400_000), (2, "s", "en", 2, "b")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for c in ("tree", "rank", "total", "digest", "leaf", "carried", "changed", "part", "path", "edited"):
        docs = docs.withColumn(c, F.lit(7))
    assert run(docs) == brute(rows)


def test_parents_keep_the_states_before_their_slots(spark):
    rows = [(i, "s", "en", i, "t") for i in range(5)]
    leaves = merkle.document_leaves(spark.createDataFrame(rows, SCHEMA), F.lit(False), bytes)
    nodes = merkle.manifest(leaves).stages[0].collect()
    level0 = {r.place: bytes(r.digest) for r in nodes if r.level == 0}
    parent = next(r for r in nodes if r.level == 1 and r.place == 0)
    kept = np.frombuffer(bytes(parent.states), np.uint8).reshape(3, 32)
    # Resume the last state with the last child: the parent's digest comes out.
    last = np.frombuffer(level0[2], np.uint8).reshape(1, 32)
    state = sha.absorb(sha.to_words(kept[2:]), sha.hex_blocks(last))
    assert sha.to_bytes(sha.finish(state, np.array([3])))[0].tobytes() == bytes(parent.digest)
    assert (sha.to_words(kept[:1])[:, 0] == sha.START).all()


def test_lanes_equal_hashlib():
    rng = np.random.default_rng(0)
    raw = rng.integers(0, 256, (3, 5000, 32), dtype=np.uint8)
    state = sha.fresh(5000)
    for r in raw:
        state = sha.absorb(state, sha.hex_blocks(r))
    got = sha.to_bytes(sha.finish(state, np.full(5000, 3)))
    assert [g.tobytes() for g in got] == [
        hashlib.sha256(b"".join(raw[k, i].tobytes().hex().encode() for k in range(3))).digest() for i in range(5000)]
