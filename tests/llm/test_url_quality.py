from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality, url_filter
from ledgerloom.llm.queries import URL_RULES
from tests.llm.conftest import prose

LABELS = "doc_id long, quality int, toxic int"


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    best = None
    for verdict, rule_host, rule_path in URL_RULES:
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            if best is None or len(rule_host + rule_path) > len(best[0]):
                best = (rule_host + rule_path, verdict)
    return host, path, *(best or (None, None))


def pages(spark, n=600):
    rng = random.Random(2)
    hosts = ["a.example.com", "www.example.com", "EXAMPLE.com", "sub.www.example.com", "x.net", "net", "notnet", "b.org", "spam.org", "com"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['en', 'fr', 'es', 'de'])}/{rng.randrange(99)}{rng.choice(['', '?q=1', '#x', '.html'])}"
            for _ in range(n)]
    odd = [None, "", "no scheme", "http://", "://net/es/", "http://net?x/es/", "http://a.net/es", "ftp://u@x.net:80/es/a?b", "http://x.net/es/\nz"]
    rows = [(i if i else None, u, "<html>", 1) for i, u in enumerate(urls + odd + urls[:3])]
    return spark.createDataFrame(rows, "page_id long, url string, html string, confidence int")


def test_rules_and_mined_verdicts(spark):
    df = pages(spark)
    rows = df.collect()
    labels = [(r.page_id, 0 if r.url and "spam.org" in r.url and "/fr/" in r.url else 1, 0) for r in rows if r.page_id is not None]
    index = url_filter.mine_rules(df, spark.createDataFrame(labels + [(None, 0, 0), (3, None, None)], LABELS), min_urls=5)
    mined = index.collect()
    assert [sorted(r.antecedent) for r in mined] == [["host:spam", "path:fr"]]
    got = url_filter.judge(df, index, URL_RULES).collect()
    assert len(got) == len(rows)
    expected = []
    for r in rows:
        host, path, rule, verdict = brute_rule(r.url)
        matched = bool(r.url) and host.split(".")[0] == "spam" and "fr" in path.split("/")
        expected.append((r.page_id or -1, host, path, rule or "", verdict or ("block" if matched else "allow")))
    assert sorted((r.page_id or -1, r.host, r.path, r.rule or "", r.verdict) for r in got) == sorted(expected)


def test_a_bad_site_below_one_percent_gets_a_rule(spark, tmp_path):
    from ledgerloom.llm.queries import QUERIES
    rng = random.Random(4)
    urls = [f"http://site{chr(97 + i % 20)}.org/{rng.choice(['a', 'b', 'c'])}/{i}" for i in range(1500)]
    bad = [int(rng.random() < .05) for _ in urls]
    urls += [f"http://farm.org/{rng.choice(['a', 'b', 'c'])}/{i}" for i in range(6)] + [f"http://mixed.org/a/{i}" for i in range(40)]
    bad += [1] * 6 + [0, 0, 0, 1] * 10
    rows = [(i, u, "", 1) for i, u in enumerate(urls)] + [(9_000, "http://farm.org/new/page", "", 1)]
    spark.createDataFrame(rows, "page_id long, url string, html string, confidence int").write.parquet(str(tmp_path / "pages.parquet"))
    spark.createDataFrame([(i, 1 - b, 0) for i, b in enumerate(bad)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    got = QUERIES["op3_url_filter"](spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    assert {r.page_id for r in got if r.verdict == "block"} == {*range(1500, 1506), 9_000}
    index = url_filter.mine_rules(spark.read.parquet(str(tmp_path / "pages.parquet")), spark.read.parquet(str(tmp_path / "labels.parquet")))
    assert [(r.antecedent, r.confidence) for r in index.collect()] == [(["host:farm"], 1.0)]


def test_url_filter_edges(spark):
    df = pages(spark, 30)
    none = url_filter.mine_rules(df, spark.createDataFrame([], LABELS))
    assert none.count() == 0
    assert url_filter.judge(df, none, URL_RULES).count() == df.count()
    assert url_filter.judge(df.where(F.lit(False)), none, URL_RULES).count() == 0
    assert url_filter.mine_rules(df.where(F.lit(False)), spark.createDataFrame([(1, 0, 0)], LABELS)).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = url_filter.judge(pages(spark, 30), url_filter.mine_rules(pages(spark, 30), spark.createDataFrame([], LABELS)),
                            URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


@pytest.fixture(scope="module")
def judged(spark, doc_frame):
    rng = random.Random(3)
    texts, good, sources = [], [], []
    for i in range(700):
        s = f"h{int(rng.paretovariate(.7)) % 40}"
        ok = rng.random() > (.7 if s in ("h1", "h2") else .08)
        t = prose(rng, rng.randrange(20, 80)) + "." if ok else " ".join([rng.choice(["BUY!!", "NOW!!"])] * rng.randrange(20, 60))
        texts.append(t), good.append(int(ok)), sources.append(s)
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good) if i % 2], LABELS)
    docs = doc_frame(texts, sources)
    return docs, good, sources, quality.posterior(docs, quality.fit(docs, labels)).collect()


def test_quality_held_out_and_shrinkage(judged):
    _, good, sources, rows = judged
    assert len(rows) == len(good)
    assert np.mean([r.keep == bool(good[r.doc_id]) for r in rows if r.doc_id % 2 == 0]) > 0.97
    rate = np.mean([r.evidence for r in rows])
    for host in set(sources):
        own = [r for r in rows if sources[r.doc_id] == host]
        mean = np.mean([r.evidence for r in own])
        low, high = min(mean, rate) - 1e-9, max(mean, rate) + 1e-9
        assert low <= own[0].host_rate <= high
    # One document moves its host's rate less than many do.
    sizes = {h: sources.count(h) for h in set(sources)}
    pull = {h: abs(r.host_rate - rate) / max(1e-9, abs(np.mean([x.evidence for x in rows if sources[x.doc_id] == h]) - rate))
            for h in sizes for r in [next(x for x in rows if sources[x.doc_id] == h)]}
    big, small = max(sizes, key=sizes.get), min(sizes, key=sizes.get)
    assert pull[small] < pull[big]


def test_quality_edges(spark, doc_frame):
    docs = doc_frame([(1, None), (None, ""), (1, "a b"), (1, "a b")], [None, None, "x", "x"])
    empty = quality.fit(docs, spark.createDataFrame([], LABELS))
    rows = quality.posterior(docs, empty).collect()
    assert len(rows) == 4 and all(abs(r.score - .5) < 1e-6 for r in rows)
    assert quality.posterior(docs.where(F.lit(False)), empty).count() == 0
    assert len(quality.features("x " * 100_000)) == len(quality.FEATURES)
