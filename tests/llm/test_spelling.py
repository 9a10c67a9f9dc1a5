from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import spelling

UPPER = {i: i + 32 for i in range(65, 91)}


def vocabulary(rows, least=6, count=5, noise=199):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= least and n >= count}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(v):
    out = []
    near = {w: [x for x in v if one_edit(w, x)] for w in v}
    best = {w: min(near[w], key=lambda x: (-v[x], x), default=None) for w in v}
    form = {w: b if b is not None and v[b] >= 5 * v[w] else None for w, b in best.items()}
    for w in v:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, v[w], len(near[w]), v[form[w]] if form[w] else None))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=str)


def variants_of(spark, v, **kw):
    return got(spelling.variants(spark.createDataFrame(sorted(v.items()), "word string, n long"), **kw))


def test_words_by_brute_force(spark, doc_frame):
    rng = random.Random(3)
    stock = ["Straße", "naïveté", "banana", "BANANA", "bananas", "ÀÉÎÕÜß", "short", "abc", "x×y÷zÿÿÿ", "letterbox"]
    texts = [(rng.choice([None, k, k, 5]), " ".join(rng.choices(stock, k=30)) + rng.choice(["", "1", "\n", "ŁŁŁŁ"])) for k in range(60)]
    texts += [(7, None), (8, ""), (9, texts[0][1]), (9, texts[0][1])]
    for noise in (3, 199):
        words = {r.word: r.n for r in spelling.words(doc_frame(texts), noise=noise).collect()}
        assert words == vocabulary(texts, noise=noise)


def test_the_counter_passes_on_what_it_holds(spark, doc_frame, monkeypatch):
    monkeypatch.setattr(spelling, "HELD_WORDS", 3)
    texts = [(k, "alphabet betamax gammaray deltawing epsilon") for k in range(20)]
    assert {r.word: r.n for r in spelling.words(doc_frame(texts)).collect()} == vocabulary(texts)


@pytest.mark.parametrize("seed", [1, 2])
def test_dense_neighbourhoods(spark, seed):
    # Few letters, many equal neighbours in a word: every kind of edit, at every place.
    rng = random.Random(seed)
    v = {}
    for _ in range(250):
        w = "".join(rng.choice("abé") for _ in range(rng.randrange(6, 10)))
        v[w] = rng.choice([5, 5, 25, 130, 700, 4000])
    assert variants_of(spark, v) == brute(v)


def test_chains_ties_and_ends(spark):
    v = {"aaaaaa": 5, "aaaaaaa": 25, "aaaaaaaa": 125, "aaaaaaab": 125, "xaaaaaa": 25, "caaaaaaaa": 700,
         "bridge": 30, "bridges": 5, "ridges": 4000, "fridge": 30, "bridgé": 5}
    rows = variants_of(spark, v)
    assert rows == brute(v)
    assert {r[0]: r[2] for r in rows}["aaaaaa"] == "caaaaaaaa"       # 5 -> 25 -> 125 -> 700


def test_very_long_words(spark):
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    v = {long: 500, long[1:]: 5, long[:-1]: 6, long[:9_000] + "z" + long[9_001:]: 7, "q" + long: 8, "seventh": 9}
    assert variants_of(spark, v) == brute(v)


def test_a_hot_prefix(spark):
    v = {"interstellar" + a + b: 5 + 100 * (a == "q") for a in "abcdefgq" for b in "rstuvwxyz"}
    assert variants_of(spark, v) == brute(v)


def test_empty_and_alone(spark):
    assert variants_of(spark, {}) == []
    assert variants_of(spark, {"lonely": 9}) == [("lonely", None, "lonely", 9, 0, None)]


def test_extra_columns_do_not_matter(spark, doc_frame):
    texts = [(k, "separate seperate " * 3 + "separate " * 30) for k in range(5)]
    docs = doc_frame(texts).withColumn("word", F.lit("other")).withColumn("n", F.lit(1))
    assert got(spelling.variants(spelling.words(docs))) == brute(vocabulary(texts))


def test_no_table_of_all_words_is_broadcast(spark):
    words = spark.createDataFrame([(w,) for w in ("banana", "bananas", "banane", "orange", "oranges")], "word string")
    found = spelling.neighbours(words, 3, False, "small")
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert ("banana", "bananas") in {tuple(r) for r in found.collect()}
    rows = spelling.variants(words.selectExpr("word", "if(word = 'banana', 9L, 1L) as n"), name="small")
    joins = [r for r in rows._jdf.queryExecution().sparkPlan().toString().splitlines() if "Join" in r]
    assert joins and not any("Broadcast" in j for j in joins)
