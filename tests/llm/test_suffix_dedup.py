from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import suffix_dedup
from ledgerloom.llm.suffix_sort import suffix_arrays


def test_suffix_arrays_equal_sorting():
    rng = np.random.default_rng(1)
    for _ in range(150):
        texts = []
        for _ in range(rng.integers(1, 8)):
            t = rng.integers(1, 1 + rng.integers(1, 4), rng.integers(0, 40))
            if rng.random() < .3 and len(t):
                t = np.tile(t[:max(1, len(t) // 5)], 5)
            texts.append(np.append(t, 0))
        first = np.cumsum([0] + [len(t) for t in texts[:-1]])
        expected = [f + i for f, t in zip(first, texts) for i in sorted(range(len(t)), key=lambda i: t[i:].tolist())]
        assert suffix_arrays(np.concatenate(texts), first).tolist() == expected


def brute(texts, length):
    seen = Counter(t[a:a + length] for t in texts for a in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for a in range(len(t) - length + 1):
            if seen[t[a:a + length]] > 1:
                gone[a:a + length] = b"\1" * length
        kept = bytes(x for x, y in zip(t, gone) if not y)
        out.append((len(t), sum(gone), sum(map(bool, bytes(gone).split(b"\0"))), hashlib.sha256(kept).hexdigest()))
    return out


def corpus(rng, n=110):
    passages = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(5, 60))) for _ in range(6)]
    docs = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 8)):
            kind = rng.random()
            if kind < .5:
                parts.append(rng.choice(passages))
            elif kind < .65:
                parts.append(rng.choice(["a" * rng.randint(1, 90), "ab" * rng.randint(1, 50), "abc d" * rng.randint(1, 20)]))
            else:
                parts.append("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 30))))
        docs.append("".join(parts))
    return docs + ["", None, docs[3], docs[3]]


@pytest.mark.parametrize("length, seed, limit", [(20, 10, 4), (24, 9, 2), (40, 20, 32)])
def test_equals_brute_force(doc_frame, length, seed, limit):
    docs = corpus(random.Random(length))
    rows = suffix_dedup.without_repeats(doc_frame(docs), length=length, seed_bytes=seed, group_limit=limit).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans or ()), r.kept_sha256) for r in rows}
    assert len(rows) == len(docs)
    assert [got[i] for i in range(len(docs))] == brute([(t or "").encode() for t in docs], length)


def test_production_length_and_piecewise_scan(doc_frame, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 11)
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    shared = noise(500)
    docs = [noise(3000) + shared + noise(6000), shared, noise(700) + shared[:399], " " * 5000, noise(20), "x" * 400, "x" * 401]
    finder = suffix_dedup.Anchors(400, 200)
    whole = docs[0].encode()
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 20)
    places = finder.find(whole)[0]
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1 << 11)
    assert suffix_dedup.Anchors(400, 200).find(whole)[0].tolist() == places.tolist()
    rows = suffix_dedup.without_repeats(doc_frame(docs)).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans or ()), r.kept_sha256) for r in rows}
    assert [got[i] for i in range(len(docs))] == brute([t.encode() for t in docs], 400)


def test_ids_that_are_null_or_shared_and_empty_tables(doc_frame):
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(60))
    rows = [(None, text), (1, text), (1, text), (1, "q" + text[::-1]), (None, None)]
    got = suffix_dedup.without_repeats(doc_frame(rows), length=20, seed_bytes=10).collect()
    assert sorted(r.n_removed for r in got) == [0, 0, 60, 60, 60]
    assert suffix_dedup.without_repeats(doc_frame(rows).where(F.lit(False)), length=20, seed_bytes=10).count() == 0
