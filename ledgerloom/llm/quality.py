"""Quality by hierarchical empirical Bayes.

A document classifier, fitted on a bounded sample of labelled rows, gives each
document a chance of being good. Sites are a host and paths below it. Their
rates are the means of these chances over all documents, shrunk in two steps:
a host's towards the global rate, a path's towards its host's. How strongly is
estimated from the spread between sites by grouped sums (method of moments), so
sites with few documents stay near their prior. A document's posterior adds its
own evidence to the log-odds of its path over the global rate.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import staged

FEATURES = ("length", "word_length", "upper", "digits", "marks", "symbols", "distinct", "commonest", "repeats",
            "repeated_pairs", "repeated_lines", "ends")


class Classifier(NamedTuple):
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the first one is the bias


def features(text: str) -> list[float]:
    """Shape of a text, as shares that do not depend on its language."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), max(1, len(text))
    lowered = [w.lower() for w in words]
    counts = Counter(lowered)
    lines = text.split("\n")
    letters = sum(map(str.isalpha, text))
    return [math.log1p(n), sum(map(len, words)) / n / 10, sum(map(str.isupper, text)) / max(1, letters),
            sum(map(str.isdigit, text)) / chars, len(re.findall(r"[!?]", text)) / n,
            len(re.findall(r"[^\w\s.,;:!?'\"-]", text)) / chars, len(counts) / n, max(counts.values()) / n,
            sum(a == b for a, b in zip(lowered, lowered[1:])) / n,
            1 - len(set(zip(lowered, lowered[1:]))) / max(1, n - 1) if n > 1 else 0.0,
            1 - len(set(lines)) / len(lines), len(re.findall(r"[.!?](?:\s|$)", text)) / n]


def _vectors():
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            made = [features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.float64())), batch.column(1)], ["x", "y"])
    return run


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", max_labelled: int = 20_000) -> Classifier:
    """Ridge logistic regression on at most ``max_labelled`` labelled rows, chosen by a hash of the id.

    Several labels of one id: the least; null ids and labels other than 0 and 1
    are left out. Without labelled rows every text has the chance 0.5.
    """
    named = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .where("y in (0, 1) and id is not null").groupBy("id").agg(F.min("y").alias("y")))
    sample = staged(named.orderBy(F.xxhash64("id"), "id").limit(max_labelled), "quality-labels")
    # Bounded by max_labelled rows of two numbers, so it may be broadcast.
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = (texts.join(F.broadcast(sample), "id").select("text", "y")
            .mapInArrow(_vectors(), "x array<double>, y int").toPandas())
    width = len(FEATURES)
    if not len(rows):
        return Classifier(np.zeros(width), np.ones(width), np.zeros(width + 1))
    x, y = np.array(rows["x"].tolist()), rows["y"].to_numpy(float)
    order = np.lexsort((*x.T, y))  # sums do not depend on how the rows arrived
    x, y = x[order], y[order]
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    z = (x - mean) / scale
    a = np.concatenate([np.ones((len(z), 1)), z, z * z], axis=1)
    w, ridge = np.zeros(a.shape[1]), np.diag([1e-3, *[1.0] * (2 * width)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(mean, scale, w)


def chance(text: str | None, model: Classifier) -> float:
    z = np.clip((np.array(features(text or "")) - model.mean) / model.scale, -6, 6)
    w = model.weights
    total = w[0] + z @ w[1:1 + len(z)] + ((z * z) @ w[1 + len(z):] if len(w) > 1 + len(z) else 0.0)
    return float(1 / (1 + np.exp(-np.clip(total, -12, 12))))


def _logit(p: Column) -> Column:
    bounded = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), p))
    return F.log(bounded / (F.lit(1.0) - bounded))


def _strength(groups: DataFrame, prior: Column) -> float:
    """How many documents the prior weighs: from how far site means scatter beyond what their sizes explain."""
    within = prior * (F.lit(1.0) - prior)
    n, sites, squares, noise, spread = groups.agg(
        F.sum("n"), F.count("*"), F.sum(F.col("n") * F.col("n")), F.sum(within),
        F.sum(F.col("n") * (F.col("good") / F.col("n") - prior) ** 2)).first()
    if not sites or sites < 2 or not n:
        return 1.0
    between = (spread - noise) / max(1e-9, n - squares / n)
    level = noise / sites
    return float(min(1e6, max(1.0, level / between - 1))) if between > 0 else 1e6


def posterior(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text",
              host_col: str = "source", path_col: str = "lang", least: float = 0.5) -> DataFrame:
    """``(doc_id, evidence, host_rate, path_rate, score, keep)``, one row per input row.

    ``evidence`` is the classifier's chance, the rates are the shrunk site
    posteriors, ``score`` combines them and ``keep`` is score >= ``least``. A null
    host or path is a site of its own; null and empty texts have the evidence of
    an empty text; ids may be null or repeated; an empty table gives no rows;
    other columns are ignored.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            p = [chance(t, model) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(p, pa.float64())], ["doc_id", "host", "path", "p"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{host_col}`").cast("string").alias("host"),
                         F.col(f"`{path_col}`").cast("string").alias("path"), F.col(f"`{text_col}`").cast("string").alias("text"))
    seen = staged(narrow.mapInArrow(run, "doc_id long, host string, path string, p double"), "quality-seen")
    paths = staged(seen.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good")), "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    n, good = hosts.agg(F.sum("n"), F.sum("good")).first()
    rate = good / n if n else 0.5
    weight = _strength(hosts, F.lit(rate))
    hosts = hosts.select(F.col("host").alias("of_host"),
                         ((F.col("good") + F.lit(weight * rate)) / (F.col("n") + F.lit(weight))).alias("host_rate"))
    nested = staged(paths.join(hosts, F.col("host").eqNullSafe(F.col("of_host"))).drop("of_host"), "quality-nested")
    below = _strength(nested, F.col("host_rate"))
    sites = nested.select(F.col("host").alias("of_host"), F.col("path").alias("of_path"), "host_rate",
                          ((F.col("good") + F.lit(below) * F.col("host_rate")) / (F.col("n") + F.lit(below))).alias("path_rate"))
    total = _logit(F.col("p")) + _logit(F.col("path_rate")) - _logit(F.lit(rate))
    score = F.lit(1.0) / (F.lit(1.0) + F.exp(-total))
    return (seen.join(sites, F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path")))
            .select("doc_id", F.col("p").alias("evidence"), "host_rate", "path_rate", score.alias("score"))
            .withColumn("keep", F.col("score") >= least))
