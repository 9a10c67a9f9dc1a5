from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import toxicity
from tests.llm.conftest import prose


def all_maximal(values):
    """Maximal scoring segments by definition: the best segment, then the same to its left and right."""
    if not values:
        return []

    def best(a, b):
        top = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += values[j]
                if total > 1e-12 and (top is None or total > top[2] + 1e-12 or (abs(total - top[2]) <= 1e-12 and j - i < top[1] - top[0])):
                    top = (i, j, total)
        return top

    out, work = [], [(0, len(values))]
    while work:
        a, b = work.pop()
        top = best(a, b)
        if top:
            out.append(top)
            work += [(a, top[0]), (top[1] + 1, b)]
    return sorted(out)


def test_segments_equal_the_definition():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randrange(0, 25)
        hits = [(i, rng.choice([0.7, 1.9, 3.3])) for i in range(n) if rng.random() < .35]
        values = [-0.45] * n
        for i, g in hits:
            values[i] = g
        got = toxicity.maximal_segments(hits, 0.45)
        expected = all_maximal(values)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in expected]
        assert np.allclose([s for *_, s in got], [s for *_, s in expected])


@pytest.fixture(scope="module")
def world(spark, doc_frame):
    rng = random.Random(6)
    bad = ["scum", "idiotic", "idiots", "moronly", "Trash"]
    rows, labels = [], []
    for i in range(900):
        words, toxic = prose(rng, rng.randrange(5, 90)).split(), rng.random() < .2
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                words.insert(rng.randrange(len(words) + 1), rng.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    copy = prose(rng, 60)  # a group of copies that happens to be labelled toxic
    rows += [(2000 + i, copy) for i in range(60)]
    labels += [(2000 + i, 1, 1) for i in range(60)]
    shape = "doc_id long, quality int, toxic int"
    train = [x for x in labels if x[0] % 3] + [(None, 1, 1), (5, None, None), (1, 1, labels[1][2])]
    model = toxicity.train(doc_frame(rows), spark.createDataFrame(train, shape))
    return rows, labels, model


def test_held_out_accuracy(doc_frame, world):
    rows, labels, model = world
    got = {r.doc_id: r for r in toxicity.score(doc_frame(rows), model).collect()}
    held = [(i, y) for i, _, y in labels if i % 3 == 0 and i < 2000]
    assert np.mean([got[i].predicted == y for i, y in held]) > 0.97
    assert all(0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= .5) for i, _ in held)
    assert not any(w.startswith("w1") for w in model.log_odds), "copies must not teach their words"
    for i, text in rows[:200]:
        for s in got[i].spans:
            assert any(b in text[s.start:s.end].lower() for b in ("scum", "idiot", "moron", "trash"))


def test_whole_texts_are_read(world):
    model = world[2]
    late = "fine " * 30_000 + "scum idiots Trash"
    spans = toxicity.passages(late, model)
    assert spans and late[spans[0].start:spans[0].end] == "scum idiots Trash"
    assert toxicity.passages("İstanbul İİ scum scum scum", model)[0].start == 12


def test_edges(spark, doc_frame, world):
    model = world[2]
    rows = [(1, None), (1, ""), (None, "scum scum scum"), (2, "scum scum scum"), (2, "scum scum scum")]
    got = toxicity.score(doc_frame(rows), model).collect()
    assert [r.predicted for r in sorted(got, key=lambda r: r.score)] == [0, 0, 1, 1, 1]
    assert len({r.score for r in got}) == 2
    clean = toxicity.without_toxic(doc_frame(rows), model)
    assert clean.columns == doc_frame(rows).columns and clean.count() == 2
    assert toxicity.score(doc_frame(rows).where(F.lit(False)), model).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    plain = toxicity.train(doc_frame(rows), none)
    assert len({r.score for r in toxicity.score(doc_frame(rows), plain).collect()}) == 1
    ones = spark.createDataFrame([(2, 1, 0)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.score(doc_frame(rows), toxicity.train(doc_frame(rows), ones)).collect()} == {0}


SHAPE = "doc_id long, quality int, toxic int"


@pytest.mark.parametrize("labels", [[], [(0, 1, None), (1, 1, None)], [(9_000, 1, 1), (9_001, 1, 0)],
                                    [(i, 1, 1) for i in range(9)], [(i, 1, 0) for i in range(9)],
                                    [(i, 1, int(i < 6)) for i in range(9)], [(i, 1, int(i < 8)) for i in range(9)]],
                         ids=["none", "null", "elsewhere", "toxic", "clean", "nothing stands out", "mostly toxic"])
def test_a_model_without_evidence_rejects_nothing(spark, doc_frame, tmp_path, labels):
    import corpus_pipeline
    docs = doc_frame([f"plain text {i}" for i in range(20)] + [None], extra=False)
    frame = spark.createDataFrame(labels, SHAPE)
    model = toxicity.train(docs, frame)
    scored = toxicity.score(docs, model).collect()
    assert all(r.predicted == 0 and r.score < 0.5 for r in scored)
    assert toxicity.without_toxic(docs, model).count() == 21
    frame.write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).count() == 21


def test_the_bounded_sample_is_of_labels_that_have_a_document(spark, doc_frame, world):
    rows, labels, _ = world
    absent = [(10_000 + i, 1, i % 2) for i in range(9_000)]
    train = spark.createDataFrame(labels + absent, SHAPE)
    plain = toxicity.train(doc_frame(rows), spark.createDataFrame(labels, SHAPE), max_labelled=960)
    model = toxicity.train(doc_frame(rows), train, max_labelled=960)
    assert model.log_odds and model == plain
    repeated = toxicity.train(doc_frame(rows + rows[:1] * 500), train, max_labelled=960)
    assert repeated.log_odds == plain.log_odds and abs(repeated.bias - plain.bias) < 1e-6


@pytest.mark.parametrize("bias, slope", [(-4.0, 0.0), (-0.1, 0.3), (-2.0, 1e-9), (-1e-17, 1e-18)])
def test_predicted_follows_from_the_score(doc_frame, world, bias, slope):
    model = world[2]._replace(bias=bias, slope=slope)
    rows = [(i, t) for i, t in enumerate(["", "scum", "scum scum idiot", "plain words only", None])]
    got = toxicity.score(doc_frame(rows), model).collect()
    assert all(r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.without_toxic(doc_frame(rows), model).count() == sum(1 - r.predicted for r in got)


def test_a_text_without_evidence_is_kept_though_most_labels_are_toxic(spark, doc_frame):
    rng = random.Random(5)
    rows = [(i, prose(rng, 30) + (" scum idiot scum" if i % 5 else "")) for i in range(300)]
    model = toxicity.train(doc_frame(rows), spark.createDataFrame([(i, 1, int(i % 5 > 0)) for i in range(300)], SHAPE))
    got = {r.doc_id: r for r in toxicity.score(doc_frame(rows), model).collect()}
    assert not any(got[i].predicted for i in range(0, 300, 5))
