from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate
from tests.llm.conftest import prose


def runs(words, k=5):
    return [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))] if words else []


def brute(texts, items, least=0.8):
    out = {}
    for item, item_text in items:
        own = (item_text or "").encode().lower().split()
        own = [w.decode() for w in own]
        if not own:
            continue
        width = min(5, len(own))
        want = Counter(runs(own, width))
        for doc, text in texts:
            words = [w.decode() for w in (text or "").encode().lower().split()]
            if len(words) < width:
                continue
            span = min(len(own), len(words)) - width + 1
            all_runs = runs(words, width)
            for a in range(len(all_runs) - span + 1):
                have = Counter(all_runs[a:a + span])
                shared = sum((have & want).values())
                s = shared / (span + sum(want.values()) - shared)
                if s >= least:
                    out[doc, item] = max(out.get((doc, item), 0), s)
    return out


def cases():
    rng = random.Random(7)
    items = [(i, prose(rng, rng.randrange(5, 60))) for i in range(40)]
    items += [(90, "tiny"), (91, "two words"), (92, ""), (93, None), (94, items[0][1]), (95, "a " * 40), (96, "Ä b C d E")]
    texts = []
    for i in range(160):
        body = prose(rng, rng.randrange(0, 120)).split()
        if rng.random() < .6:
            own = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                if own:
                    own[rng.randrange(len(own))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = own[rng.choice([0, 0, 1]):]
        texts.append((i, " ".join(body)))
    return texts + [(900, None), (901, ""), (902, " ".join(items[3][1].split()[:-1])), (903, items[5][1].upper()), (904, "a\ta\n" * 30)], items


@pytest.mark.parametrize("block_bytes", [4 << 20, 1500])
def test_equals_brute_force(spark, doc_frame, block_bytes):
    texts, items = cases()
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.contaminated(doc_frame(texts), bench, block_bytes=block_bytes).collect()
    found = {(r.doc_id, r.item_id): r.similarity for r in got}
    assert len(found) == len(got)
    assert found == pytest.approx(brute(texts, items))
    clean = decontaminate.without_leaks(doc_frame(texts), bench, block_bytes=block_bytes)
    assert clean.columns == doc_frame(texts).columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in texts} - {d for d, _ in found}


def test_blocks_find_every_code_within_the_radius():
    rng = random.Random(1)
    import numpy as np
    index = decontaminate.build_index([(i, prose(rng, 12).encode()) for i in range(100)], 5, 23)
    group, = index.groups
    for i, code in enumerate(group.codes.tolist()):
        for _ in range(30):
            other = code
            for b in rng.sample(range(64), 23):
                other ^= 1 << b
            byte = np.array([other], np.uint64).view(np.uint8)
            assert any(int(group.near[k, byte[k], i // 64]) >> (i % 64) & 1 for k in range(8))
    with pytest.raises(ValueError):
        next(decontaminate._indexes(None, "", "", 5, 24, 1))


def test_empty_tables_and_repeats(spark, doc_frame):
    bench = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    docs = doc_frame([(1, "x a b c d e f g y"), (1, "x a b c d e f g y"), (None, "A B C D E F G")])
    assert decontaminate.contaminated(docs, bench).count() == 3
    assert decontaminate.contaminated(docs.where(F.lit(False)), bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where(F.lit(False))).count() == 0
    assert decontaminate.without_leaks(docs, bench.where(F.lit(False))).count() == 3


def test_rows_do_not_depend_on_the_blocks(spark, doc_frame):
    rng = random.Random(8)
    items = [(rng.choice([1, 2, None, k]), prose(rng, 14)) for k in range(12)]
    items += [(7, items[0][1]), (7, items[0][1]), (1, items[3][1])]         # ids and texts that repeat
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = doc_frame([prose(rng, 20) + " " + " ".join(t for _, t in rng.sample(items, 3)) + " " + prose(rng, 9) for _ in range(15)])
    found = [sorted(map(str, decontaminate.contaminated(docs, bench, block_bytes=size).collect())) for size in (4 << 20, 400, 100)]
    assert found[0] and found[0] == found[1] == found[2]
