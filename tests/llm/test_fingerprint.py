from __future__ import annotations

import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import fingerprint
from tests.llm.conftest import prose

SKETCH = fingerprint.Sketcher()


def shingles(text, k=5):
    words = text.encode().lower().split()
    return {b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def likeness(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def test_estimates_follow_the_true_similarity():
    rng = random.Random(3)
    off = []
    for n in (8, 30, 200, 2000):
        for _ in range(25):
            a = prose(rng, n)
            cut = rng.randrange(1, n)
            b = " ".join(a.split()[:cut]) + " " + prose(rng, n - cut)
            off.append(fingerprint.likeness(SKETCH(a.encode()), SKETCH(b.encode())) - likeness(a, b))
    assert abs(np.mean(off)) < 0.02
    assert np.std(off) < 0.08


def test_few_shingles_do_not_collide():
    other = [fingerprint.likeness(SKETCH(b"one word"), SKETCH(b"word %d" % i)) for i in range(200)]
    assert max(other) < 0.2


def test_comparison_equals_brute_force(spark, doc_frame):
    rng = random.Random(4)
    texts = [prose(rng, rng.randrange(0, 60)) for _ in range(150)] + ["", None, "é", "🙂🙂🙂🙂 x", prose(rng, 20_000)]
    texts[20] = texts[21] = texts[22]
    rows = [(3 * i - 40, t) for i, t in enumerate(texts)]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    got = {r.doc_id: r for r in fingerprint.edit_comparison(doc_frame(shuffled)).collect()}
    assert len(got) == len(rows)
    for k, (i, t) in enumerate(rows):
        t, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        cut = len(t) // 4
        changed = t[:len(t) - cut] + following[:cut]
        r = got[i]
        own, other, after = (SKETCH(x.encode()) for x in (t, changed, following))
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint.packed(own).hex(), fingerprint.packed(other).hex())
        assert (fingerprint.unpacked(fingerprint.packed(own)) == own).all()
        assert r.near_edited == fingerprint.likeness(own, other)
        assert r.near_next == fingerprint.likeness(own, after)
    assert got[rows[20][0]].near_next == 1.0


def test_edges(doc_frame):
    alone = fingerprint.edit_comparison(doc_frame([(4, "abcd efgh")])).collect()
    assert [(r.doc_id, r.near_next, r.n_chars) for r in alone] == [(4, 1.0, 9)]
    assert fingerprint.edit_comparison(doc_frame([(4, "x")]).where(F.lit(False))).count() == 0
    rows = [(None, "a b"), (1, "c d"), (1, "c d"), (1, "b a"), (None, None)]
    got = fingerprint.edit_comparison(doc_frame(rows)).collect()
    assert len(got) == 5
    prints = {(r.doc_id, r.fingerprint) for r in fingerprint.fingerprints(doc_frame(rows))
              .withColumn("fingerprint", F.lower(F.hex("fingerprint"))).collect()}
    assert {(r.doc_id, r.fingerprint) for r in got} == prints
    assert (None, "") in prints
