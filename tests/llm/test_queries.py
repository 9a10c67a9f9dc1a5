from __future__ import annotations

import os
import subprocess
import sys

import duckdb
import pytest

import corpus_pipeline
from ledgerloom.llm import simhash, toxicity
from ledgerloom.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def oracle(sql):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = con.execute(sql)
    return [d[0] for d in found.description], found.fetchall()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_its_sql(spark, name):
    df = QUERIES[name](spark, SF)
    columns, rows = oracle(ORACLE[name])
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(tuple, df.select(*columns).collect()), key=str) == sorted(rows, key=str)


def test_every_operator_has_a_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]


def test_pipeline_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns = docs.columns
    kept = corpus_pipeline.drop_toxic(spark, docs, SF)
    assert kept.columns == columns
    model = toxicity.train(docs, labels)
    judged = {r.doc_id: r.predicted for r in toxicity.score(docs, model).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, p in judged.items() if not p}

    from tests.llm.test_lines import brute
    cut = corpus_pipeline.drop_frequent_lines(spark, docs, SF)
    assert cut.columns == columns
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], 10, False)
    got = {r.doc_id: r for r in cut.collect()}
    assert {i: r.text for i, r in got.items()} == expected
    assert all(r.n_chars == len(r.text) for r in got.values())

    from tests.llm.test_simhash import brute_groups
    rows = sorted(docs.collect(), key=lambda r: r.doc_id)
    groups = brute_groups([simhash.fingerprint(r.text.encode()) for r in rows], 4)
    once = corpus_pipeline.drop_near_duplicates(spark, docs, SF)
    assert once.columns == columns
    assert sorted(r.doc_id for r in once.collect()) == [rows[g].doc_id for g in sorted(set(groups))]

    from tests.llm.test_decontaminate import brute as leaks
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    short = [r for r in rows if len(r.text) < 3000]
    found = {d for d, _ in leaks([(r.doc_id, r.text) for r in short], items)}
    clean = corpus_pipeline.drop_leaks(spark, docs, SF)
    assert clean.columns == columns
    left = {r.doc_id for r in clean.collect()}
    assert {r.doc_id for r in short} - left == found


def test_whole_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "decontamination", "mixing"]
    assert rows and set(rows[0].asDict()) == {"doc_id", "size", "source_size", "target", "taken"}
    assert len({r.doc_id for r in rows}) == len(rows)


def test_the_library_works_without_this_subpackage(tmp_path):
    code = ("import sys; sys.modules['ledgerloom.llm'] = None; sys.modules['corpus_pipeline'] = None; sys.path.insert(0, sys.argv[1]); "
            "import __spark_entry__ as e; assert 'total_sales' in e.queries() and not any(n.startswith('op') for n in e.queries() if n[2:3].isdigit()); "
            "assert 'pipeline' not in e.queries(); e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code, ROOT], check=True, cwd=tmp_path, timeout=120)


def test_executors_need_not_have_the_package(tmp_path):
    code = ("import sys; sys.path.insert(0, sys.argv[1])\n"
            "from ledgerloom.session import build_session\n"
            "from ledgerloom.llm.queries import QUERIES\n"
            "s = build_session(master='local[2]', shuffle_partitions=2, extra={'spark.driver.memory': '2g'})\n"
            "for n in ('op2_suffix_dedup', 'op4_quality', 'op5_mixing', 'op7_chat_tree', 'op8_fingerprints', 'op9_decontaminate', 'op10_toxicity', 'op11_packing', 'op12_spelling', 'op13_merkle'):\n"
            "    QUERIES[n](s, sys.argv[2]).count()\n")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code, ROOT, SF], check=True, cwd=tmp_path, env=env, timeout=400)
