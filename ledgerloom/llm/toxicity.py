"""Toxicity: maximum-scoring segments of token log-odds.

Tokens get the log-odds of the toxic against the clean class under an
informative Dirichlet prior (its shape is the sample's own token frequencies,
plus a half for each token). Tokens are words and, as a word has many forms,
word beginnings; a word takes the log-odds of its longest listed token. Tokens
whose log-odds stand out from their standard error are listed; every other word
costs ``gap_cost``. One linear scan finds all maximal
scoring segments of a text, and extreme-value statistics (expected number of
segments of that score in a clean text of that length) tell the significant
ones. A document's score is calibrated on its evidence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import WordHashes, lower_words, staged, word_shingles

TOKEN = re.compile(r"\w+")
BEGINNINGS = (6, 4)
EVIDENCE = 50.0         # evidence beyond 10 ** -50 counts the same
NO_EVIDENCE = -4.0      # the bias of a model that learned nothing
LEAST_DOUBT = -0.1      # the largest bias of one that did


def word_tokens(word: str) -> list[str]:
    """The word, then its beginnings, longest first."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if len(word) > n)]


class Model(NamedTuple):
    """``log_odds`` of the tokens that stand out, the cost of others, the
    extreme-value parameters and the two calibration weights.

    Without a positive ``slope`` the labels told nothing apart (none, one class
    only, or no token that stands out). A text without evidence always scores
    below a half, whatever share of the labels is toxic.
    """

    log_odds: dict[str, float]
    gap_cost: float
    rate: float
    scale: float
    bias: float
    slope: float

    def chance(self, x: float) -> float:
        """The score of a text with evidence ``x``."""
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.slope * x))))

    def rejects(self, x: float) -> bool:
        return self.chance(x) >= 0.5


class Passage(NamedTuple):
    start: int  # code points
    end: int
    score: float
    expected: float  # number of such segments in a clean text of this length


def maximal_segments(scores: list[tuple[int, float]], gap_cost: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments, in order, as (first token, last token, score).

    ``scores`` lists the tokens that score above 0, by position; tokens between
    them cost ``gap_cost`` each. Each entry is pushed once and merged at most
    once, as the sums to the left and right of each candidate decide.
    """
    stack: list[list] = []  # first, last, sum before, sum through; and the nearest candidate with a smaller left sum
    total, at = 0.0, -1
    for place, gain in scores:
        total -= gap_cost * (place - at - 1)
        segment = [place, place, total, total + gain, -1]
        total, at = total + gain, place
        while True:
            j = len(stack) - 1
            while j >= 0 and stack[j][2] >= segment[2]:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= segment[3]:
                segment[4] = j
                stack.append(segment)
                break
            segment = [stack[j][0], segment[1], stack[j][2], segment[3], -1]
            del stack[j:]
    return [(a, b, through - before) for a, b, before, through, _ in stack]


def _hits(text: str, log_odds: dict[str, float]) -> tuple[int, list[tuple[int, float, re.Match]]]:
    count, found = 0, []
    for m in TOKEN.finditer(text):
        word = m[0]
        gain = log_odds.get(word)
        if gain is None and len(word) > BEGINNINGS[1]:
            gain = log_odds.get(word[:BEGINNINGS[0]] + "*") if len(word) > BEGINNINGS[0] else None
            if gain is None:
                gain = log_odds.get(word[:BEGINNINGS[1]] + "*")
        if gain is not None:
            found.append((count, gain, m))
        count += 1
    return count, found


def passages(text: str, model: Model, most_expected: float = 0.01) -> list[Passage]:
    """The significant toxic passages of a text, whose expected number is at most ``most_expected``."""
    count, found = _hits(_lowered(text), model.log_odds)
    spans = {place: m.span() for place, _, m in found}
    out = []
    for a, b, score in maximal_segments([(p, g) for p, g, _ in found], model.gap_cost):
        expected = model.scale * max(count, 1) * math.exp(-model.rate * score)
        if expected <= most_expected:
            out.append(Passage(spans[a][0], spans[b][1], score, expected))
    return out


def _lowered(text: str) -> str:
    """Lower case that keeps each code point's place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


def evidence(text: str, log_odds: dict[str, float], gap_cost: float, rate: float, scale: float) -> float:
    """-log10 of the chance that a clean text of this length holds segments as strong, summed over
    the segments that fewer than one of are expected; at most ``EVIDENCE``."""
    count, found = _hits(_lowered(text), log_odds)
    total = 0.0
    for _, _, score in maximal_segments([(p, g) for p, g, _ in found], gap_cost):
        total += max(0.0, (rate * score - math.log(scale * max(count, 1))) / math.log(10))
    return min(EVIDENCE, total)


def _rate(gains: np.ndarray, chances: np.ndarray, gap_cost: float) -> float:
    """The positive root of sum(chance * exp(rate * score)) = 1 over clean tokens."""
    rest = max(0.0, 1 - float(chances.sum()))
    total = lambda r: float((chances * np.exp(r * gains)).sum()) + rest * math.exp(-r * gap_cost)
    low, high = 0.0, 1.0
    while total(high) < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if total(mid) < 1 else (low, mid)
    return max(high, 0.05)


def _calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Ridge logistic regression of the label on the evidence, by Newton steps."""
    a = np.stack([np.ones(len(x)), x], axis=1)
    w, ridge = np.zeros(2), np.diag([1e-3, 1e-1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + ridge, a.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", max_labelled: int = 20_000, prior: float = 2_000.0, least_z: float = 3.0,
          least_gain: float = 3.0, least_docs: int = 5, gap_cost: float = 0.5) -> Model:
    """Fit the model on at most ``max_labelled`` labelled documents, chosen by a hash of the id
    among the labels that have a document; rows that repeat id and text are one document.

    Documents that share their least 5-word shingle hash (copies, and most near
    copies) count once, so a group of copies does not make its words toxic; a
    token counts once a document. A token must occur in ``least_docs`` toxic documents of the sample, which
    bounds the model. Several labels of one id: the largest; labels that are
    null or other than 0 and 1, and ids that are null, are left out. Without
    usable labels, or with labels of one class only, every text scores the same
    and none is rejected.
    """
    named = (labels.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .where("y in (0, 1) and id is not null").groupBy("id").agg(F.max("y").alias("y")))
    texts = (docs.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                         F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
             .withColumn("h", F.xxhash64("text")))
    # Only labels that meet a document count against the bound.
    met = texts.select("id", "h").join(named, "id").distinct()
    sample = staged(met.orderBy(F.xxhash64("id"), "id", "h").limit(max_labelled), "toxicity-labels")

    def tokens(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in rows:
            least, words = [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                shingles = word_shingles(lower_words(text), 5, hashes)
                least.append(int(shingles.min().view(np.int64)) if len(shingles) else 0)
                own = set(TOKEN.findall(_lowered(text.decode())))
                words.append(list({t for w in own for t in word_tokens(w)}))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(least, pa.int64()), pa.array(words, pa.list_(pa.string()))],
                ["id", "y", "least", "words"])

    # The sample is bounded by max_labelled rows of three numbers, so it may be broadcast.
    chosen = staged(texts.join(F.broadcast(sample), ["id", "h"]).groupBy("id", "h")
                    .agg(F.first("text").alias("text"), F.first("y").alias("y")).select("id", "text", "y"), "toxicity-texts")
    counted = chosen.mapInArrow(tokens, "id long, y int, least long, words array<string>")
    single = staged(counted.groupBy("y", "least").agg(F.min_by("words", "id").alias("words"))
                    .select("y", F.explode("words").alias("w"))
                    .groupBy("w").agg(F.count(F.when(F.col("y") == 1, 1)).alias("bad"),
                                      F.count(F.when(F.col("y") == 0, 1)).alias("good")), "toxicity-tokens")
    bad, good = single.agg(F.sum("bad"), F.sum("good")).first()
    if not bad or not good:
        return Model({}, gap_cost, 1.0, 1.0, NO_EVIDENCE, 0.0)
    alpha = F.lit(0.5) + F.lit(prior) * (F.col("bad") + F.col("good")) / F.lit(float(bad + good))
    up, down = F.col("bad") + alpha, F.col("good") + alpha
    odds = F.log(up / (F.lit(bad + prior) - up)) - F.log(down / (F.lit(good + prior) - down))
    scored = single.select("w", "bad", odds.alias("gain"), (F.lit(1.0) / up + F.lit(1.0) / down).alias("var"),
                           (down / F.lit(good + prior)).alias("chance"))
    # least_docs toxic documents of a bounded sample for each: the list is bounded too.
    listed = scored.where((F.col("bad") >= least_docs) & (F.col("gain") / F.sqrt("var") >= least_z)
                          & (F.col("gain") >= least_gain)).select("w", "gain", "chance").collect()
    log_odds = {r["w"]: float(r["gain"]) for r in listed}
    rate = _rate(np.array([r["gain"] for r in listed]), np.array([r["chance"] for r in listed]), gap_cost)

    def strongest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            out = []
            for text in batch.column(1).to_pylist():
                count, found = _hits(_lowered(text), log_odds)
                best = max((s for *_, s in maximal_segments([(p, g) for p, g, _ in found], gap_cost)), default=0.0)
                out.append(rate * best - math.log(max(count, 1)))
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(out, pa.float64())], ["y", "excess"])

    # Gumbel moments: the clean maxima exceed log(length) / rate by log(scale) + 0.5772 on average.
    mean = chosen.mapInArrow(strongest, "y int, excess double").where("y = 0").agg(F.avg("excess")).first()[0]
    scale = math.exp(min(5.0, max(-12.0, mean - 0.5772))) if mean is not None else 1.0

    def measured(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            x = [evidence(t, log_odds, gap_cost, rate, scale) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(x, pa.float64())], ["y", "x"])

    points = chosen.mapInArrow(measured, "y int, x double").toPandas()  # at most max_labelled rows
    bias, slope = _calibrated(points["x"].to_numpy(), points["y"].to_numpy(float))
    if slope <= 0:
        return Model(log_odds, gap_cost, rate, scale, NO_EVIDENCE, 0.0)
    return Model(log_odds, gap_cost, rate, scale, min(bias, LEAST_DOUBT), slope)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          most_expected: float = 0.01) -> DataFrame:
    """``(doc_id, score, predicted, spans)``, one row per input row.

    ``score`` is the chance, 0 to 1, that the text is toxic; ``predicted`` is 1
    from 0.5 on; ``spans`` are the significant passages as [start, end) in code
    points. Null and empty texts have no evidence and the score that goes with
    it. Equal texts score alike; ids may be null or repeated; other columns are
    ignored.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            chance, predicted, spans = [], [], []
            for text in batch.column(1).to_pylist():
                x = evidence(text, model.log_odds, model.gap_cost, model.rate, model.scale)
                chance.append(model.chance(x))
                predicted.append(int(chance[-1] >= 0.5))
                spans.append([{"start": p.start, "end": p.end} for p in passages(text, model, most_expected)] if x else [])
            shape = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(chance, pa.float64()),
                 pa.array(predicted, pa.int32()), pa.array(spans, shape)],
                ["doc_id", "score", "predicted", "spans"])

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, predicted int, spans array<struct<start:long,end:long>>")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, with all their columns, whose text is not predicted toxic."""
    place = docs.columns.index(text_col)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            limit = [evidence(t or "", model.log_odds, model.gap_cost, model.rate, model.scale)
                     for t in batch.column(place).to_pylist()]
            yield batch.filter(pa.array([not model.rejects(x) for x in limit], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
