from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import line_dedup


def brute(rows, min_docs, keep_first):
    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))
    owners, first = defaultdict(set), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        for line in (text or "").split("\n"):
            owners[key(line)].add(doc)
            first.setdefault(key(line), doc)
    out, used = {}, set()
    for doc, text in sorted(rows, key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            k = key(line)
            gone = k != "" and len(owners[k]) >= min_docs
            if gone and keep_first and k not in used:
                gone = False
            used.add(k)
            if not gone:
                kept.append(line)
        out[doc] = "\n".join(kept)
    return out


def corpus():
    rng = random.Random(8)
    common = ["License Agreement", "  read more ", "ÄÖ Ü", "x"]
    rows = []
    for i in range(400):
        lines = [rng.choice(common) if rng.random() < .5 else f"line {rng.randrange(90)}" for _ in range(rng.randrange(6))]
        if rng.random() < .3:
            lines += ["READ MORE\t", "", "read more"]
        rows.append((i, "\n".join(lines) if rng.random() > .02 else None))
    return rows


@pytest.mark.parametrize("keep_first", [False, True])
def test_equals_brute_force(spark, doc_frame, keep_first):
    rows = corpus()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # keys run on over many partitions
    try:
        docs = doc_frame(rows)
        bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, keep_first=keep_first)
        out = line_dedup.without_lines(docs, bitmaps)
        got = {r.doc_id: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = brute(rows, 10, keep_first)
    assert out.columns == [*docs.columns, "__llm_dropped"]
    assert len(got) == len(rows)
    for doc, text in rows:
        assert (got[doc].text or "") == expected[doc]
        assert (got[doc]["__llm_dropped"] is None) == (expected[doc] == (text or ""))


def test_bitmap_round_trip():
    import zlib
    keep = np.array([1, 0, 1, 1, 0, 0, 1, 0, 1], bool)
    text = "\n".join(f"l{i}" for i in range(9)).encode()
    assert line_dedup.kept_text(text, zlib.compress(np.packbits(keep).tobytes())) == b"l0\nl2\nl3\nl6\nl8"
    assert line_dedup.kept_text(text, None) == text


def test_edges(doc_frame):
    long = "\n".join(["same"] * 30_000)
    rows = [(i, "same") for i in range(9)] + [(9, long), (None, "same"), (None, "same\nother"), (3, "same\nthird"), (11, ""), (12, None)]
    bitmaps = line_dedup.keep_bitmaps(doc_frame(rows), min_docs=11)
    out = line_dedup.without_lines(doc_frame(rows), bitmaps).collect()
    assert len(out) == len(rows)  # ids 0-9 and the null id: 11 documents
    assert sorted(r.text or "" for r in out) == sorted([""] * 11 + ["", "other", "third", ""])
    assert line_dedup.keep_bitmaps(doc_frame(rows), min_docs=12).count() == 0
    assert line_dedup.keep_bitmaps(doc_frame(rows).where(F.lit(False))).count() == 0
    assert hashlib.sha256(line_dedup.kept_text(b"", None)).hexdigest().startswith("e3b0c442")


def events_of(rows, min_docs=3, keep_first=False):
    """The events of one sorted partition, from (h1, h2, doc_id, text_key) rows."""
    import pyarrow as pa
    columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
    batch = pa.RecordBatch.from_arrays([*columns, pa.array([1] * len(rows), pa.int32()),
                                        pa.array([[0]] * len(rows), pa.list_(pa.int32()))], list("abcdef"))
    return [tuple(e.values()) for b in line_dedup._stream(min_docs, keep_first)(iter([batch])) for e in b.to_pylist()]


def test_rows_of_one_id_are_collapsed_and_not_held():
    """Held rows come out as open ones as soon as there are more than min_docs, before the key is decided."""
    copies = events_of([(0, 0, 1, 1), *[(1, 1, None, 5)] * 1000, (1, 1, 4, 5), (1, 1, 5, 5), (2, 2, 1, 1)])
    assert sum(e[1] == 1 for e in copies) == 3, "repeated rows are one"
    texts = events_of([(0, 0, 1, 1), *[(1, 1, None, t) for t in range(1000)], (1, 1, 4, 5), (1, 1, 5, 5), (2, 2, 1, 1)])
    mine = [e for e in texts if e[1] == 1]
    assert sum(e[0] == line_dedup.OPEN for e in mine) == 1000 and sum(e[0] == line_dedup.DROP for e in mine) == 2
    assert [(e[3], e[7]) for e in mine if e[0] == line_dedup.EDGE] == [(None, 1), (5, 0)]


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [3, 4])
def test_many_texts_and_repeated_rows_of_one_id(spark, doc_frame, keep_first, min_docs):
    rows = [(None, f"same\nown {i}") for i in range(400)] + [(None, "same\ncopy")] * 300
    rows += [(7, f"same\nother {i % 50}\nlow") for i in range(200)] + [(8, "same")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # one id runs on over many partitions
    try:
        docs = doc_frame(rows, extra=False).repartition(4)
        out = line_dedup.without_lines(docs, line_dedup.keep_bitmaps(docs, min_docs=min_docs, keep_first=keep_first)).collect()
        lines = line_dedup._identified(docs, "doc_id", "text").mapInArrow(line_dedup._to_lines(1), line_dedup._LINES)
        assert lines.where("doc_id is null").count() <= 800 + 4 * 2, "a task sends a repeated row once"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(out) == len(rows)
    # The ids are null, 7 and 8: three documents; "low" and the others are in one.
    left = {r.text for r in out if "same" in r.text.split("\n")}
    texts = {t for _, t in rows}
    if min_docs == 4:
        assert {r.text for r in out} == texts
    elif keep_first:
        assert len(left) == 1 and all(r.doc_id is None for r in out if r.text in left)
    else:
        assert not left
        assert sorted(r.text for r in out) == sorted(t[5:] for _, t in rows)


def test_columns_with_the_operators_own_names(spark, doc_frame):
    import corpus_pipeline
    rows = [(i, f"shared line\nown {i}") for i in range(12)] + [(20, "alone")]
    docs = doc_frame(rows, extra=False)
    for name in ("__llm_keep", "__LLM_hash", "__llm_id", "__llm_key", "__llm_dropped", "dropped", "Dropped_"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    cut = corpus_pipeline.drop_frequent_lines(spark, docs, "")
    assert cut.columns == docs.columns
    got = {r.doc_id: r for r in cut.collect()}
    assert got[3].text == "own 3" and got[20].text == "alone"
    assert all(r["__llm_keep"] == "own __llm_keep" and r["dropped"] == "own dropped" for r in got.values())
    once = corpus_pipeline.drop_near_duplicates(spark, docs.union(docs.limit(1)), "")
    assert once.columns == docs.columns
    assert all(r["__LLM_hash"] == "own __LLM_hash" for r in once.collect())
