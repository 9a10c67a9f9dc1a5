"""Spelling variants: words one edit apart, found by walking a trie held as a table of edges.

A state is (word, position, node, edits): so much of the word is read, and the
node is where that leads in the trie of all words with so many edits. States
join the edges of their node; one step reads a whole edge, as nodes with a
single way on are merged into their edge (a word of any length has few steps).
Without an edit a word follows its own path; an edit can only leave that path
at a node with several ways on. After the edit the rest of the word must be
read exactly, and a state that has read it all at the end of a word is a
neighbour.

Near its root a trie has every letter everywhere, so edits are only made in the
second half of a word; a second trie of the reversed words takes those of the
first half. A state is dropped as soon as its node has no way on for the word's
next letter. Nodes are named by a 128-bit hash of their prefix, the rest of an
edge by a 64-bit hash; neighbours found are compared exactly.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.shared import raw_bytes, small_batches, staged

HELD_WORDS = 1 << 18        # words that a task counts before it passes them on
# How tables that grow with the vocabulary are joined. Spark takes a word for the few bytes it has in a file, less
# after a Python function, and would build tables of all words on the driver.
SORTED = "merge"


# -------------------------------------------------------------------- words

def words(docs: DataFrame, min_chars: int = 6, min_count: int = 5, noise: int = 199) -> DataFrame:
    """``(word, n)``: maximal runs of [A-Za-z\\u00C0-\\u00FF], A-Z lower-cased, of at least
    ``min_chars`` code points and ``min_count`` occurrences over all documents.

    With ``noise``, a run whose crc32 of ``<doc_id>:<run>`` it divides loses one code
    point first (a null id counts as empty). Null and empty texts have no words;
    repeated rows count each time.
    """
    small_batches(docs.sparkSession)
    runs = re.compile(f"[A-Za-zÀ-ÿ]{{{min_chars},}}")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def passed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])
            held.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), raw_bytes(b.column(1))):
                if not text:
                    continue
                head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(runs.findall(text.lower().decode())).items():
                    h = zlib.crc32(run.encode(), head)
                    if noise and h % noise == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1:]
                        if len(run) < min_chars:
                            continue
                    held[run] += n
                if len(held) > HELD_WORDS:
                    yield passed()
        if held:
            yield passed()

    found = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (found.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= min_count))


# --------------------------------------------------------------------- trie

def _prefixes(vocabulary: DataFrame, least: int) -> DataFrame:
    """``(word_id, depth, node, follows)`` of every prefix of at least ``least`` code points:
    the letter that follows it in the word, empty at the word's end."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[], [], [], []]
            for word in b.column(0).to_pylist():
                state = xxhash.xxh3_128(word[:least].encode())
                nodes = [state.digest()]
                for letter in word[least:]:
                    state.update(letter.encode())
                    nodes.append(state.digest())
                rows[0] += nodes[-1:] * len(nodes)
                rows[1] += range(least, len(word) + 1)
                rows[2] += nodes
                rows[3] += [*word[least:], ""]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.binary()), pa.array(rows[1], pa.int32()), pa.array(rows[2], pa.binary()), pa.array(rows[3])],
                ["word_id", "depth", "node", "follows"])
    return vocabulary.select("word").mapInArrow(cut, "word_id binary, depth int, node binary, follows string")


def _part(word: Column | str, at: Column | int, length: Column | int | None = None) -> Column:
    """``length`` code points of ``word`` from position ``at`` (from 0)."""
    w = F.col(word) if isinstance(word, str) else word
    start = (at if isinstance(at, Column) else F.lit(at)) + 1
    n = F.length(w) if length is None else length if isinstance(length, Column) else F.lit(length)
    return w.substr(start, n)


def trie(vocabulary: DataFrame, least: int, name: str) -> tuple[DataFrame, DataFrame]:
    """``(word, path)``, the nodes (depth, node) with several ways on or a word's end along each
    word, and the edges ``(node, letter, length, rest, child, ways, ends)`` between such nodes."""
    prefixes = _prefixes(vocabulary, least)
    nodes = (prefixes.groupBy("node").agg(F.collect_set("follows").alias("ways"))       # at most one entry a letter
             .select("node", F.array_contains("ways", "").alias("ends"), F.array_join("ways", "").alias("ways"),
                     F.size("ways").alias("n")).where("n > 1 or ends"))
    nodes = staged(nodes.drop("n"), f"{name}-nodes")
    on_path = prefixes.select("word_id", "depth", "node").join(nodes.select("node").hint(SORTED), "node", "left_semi")
    paths = on_path.groupBy("word_id").agg(F.sort_array(F.collect_list(F.struct("depth", "node"))).alias("path"))
    # A word's id is the node it ends at.
    named = vocabulary.select("word", _end("word").alias("word_id"))
    paths = staged(paths.join(named.hint(SORTED), "word_id").select("word", "path"), f"{name}-paths")
    steps = paths.select("word", F.explode(F.transform(
        F.slice("path", 1, F.size("path") - 1), lambda x, i: F.struct(x.alias("a"), F.element_at("path", i + 2).alias("b")))).alias("s"))
    length = (F.col("s.b.depth") - F.col("s.a.depth")).alias("length")
    edges = steps.select(F.col("s.a.node").alias("node"), _part("word", F.col("s.a.depth"), 1).alias("letter"), length,
                         F.xxhash64(_part("word", F.col("s.a.depth") + 1, length - 1)).alias("rest"), F.col("s.b.node").alias("child"))
    edges = edges.distinct().join(nodes.select(F.col("node").alias("child"), "ways", "ends").hint(SORTED), "child")
    return paths, staged(edges.select("node", "letter", "length", "rest", "child", "ways", "ends"), f"{name}-edges")


@F.pandas_udf(T.BinaryType())
def _end(word: pd.Series) -> pd.Series:
    """The node a word ends at."""
    return word.map(lambda w: xxhash.xxh3_128_digest(w.encode()))


# ----------------------------------------------------------------- frontier

def _state(at: Column, node: str, ends: str, ways: str, when: Column) -> Column:
    """A state with one edit, or null where it is impossible: the rest of the word must go on from its node."""
    left = F.length("word") - at
    goes_on = F.when(left == 0, F.col(ends)).otherwise((left > 0) & (F.instr(F.col(ways), _part("word", at, 1)) > 0))
    return F.when(when & goes_on, F.struct(at.alias("at"), F.col(node).alias("node"), (left == 0).alias("done")))


def _reads(at: Column) -> Column:
    """The word from ``at`` on reads the edge but for its letter."""
    return (F.col("length") == 1) | ((at + F.col("length") - 1 <= F.length("word"))
                                     & (F.xxhash64(_part("word", at, F.col("length") - 1)) == F.col("rest")))


def neighbours(vocabulary: DataFrame, least: int, backwards: bool, name: str) -> DataFrame:
    """``(word, near)`` for words one edit apart in their second half (backwards: in their first)."""
    if backwards:
        vocabulary = vocabulary.withColumn("word", F.reverse("word"))
    vocabulary = staged(vocabulary.select("word"), f"{name}-words")
    paths, edges = trie(vocabulary, least, name)
    half = F.floor(F.length("word") / 2)
    first = F.length("word") - half if backwards else half
    start = paths.select("word", F.explode(F.filter("path", lambda x: x["depth"] >= first)).alias("s")).select(
        "word", F.col("s.depth").alias("at"), "s.node")
    at, letter, length = F.col("at"), F.col("letter"), F.col("length")
    here, then = _part("word", at, 1), _part("word", at + 1, 1)
    # One edit, then the edge: its letter replaces the word's, stands before it, or follows a letter left out.
    # An edit within a run of equal letters is made at the run's end.
    edited = F.array(
        _state(at + length, "child", "ends", "ways", (letter != here) & (at < F.length("word")) & _reads(at + 1)),
        _state(at + length - 1, "child", "ends", "ways", (letter != here) & _reads(at)),
        _state(at + 1 + length, "child", "ends", "ways", (letter == then) & (then != here) & _reads(at + 2)))
    frontier = start.join(edges, "node").select("word", F.explode(F.filter(edited, lambda s: s.isNotNull())).alias("s"))
    # The last letter left out: the node itself must end a word.
    ended = vocabulary.select(_end("word").alias("node"))
    whole = start.where(F.col("at") == F.length("word") - 1).join(ended.hint(SORTED), "node", "left_semi").select("word", "node")
    frontier = staged(frontier.select("word", "s.at", "s.node", "s.done"), f"{name}-frontier")
    found = [whole, frontier.where("done").select("word", "node")]
    while True:
        going = frontier.where("not done")
        if going.isEmpty():
            break
        going = going.withColumn("letter", _part("word", F.col("at"), 1)).drop("done").withColumnRenamed("node", "from")
        step = going.join(edges, (F.col("from") == F.col("node")) & (going["letter"] == edges["letter"])).drop(edges["letter"])
        after = _state(F.col("at") + F.col("length"), "child", "ends", "ways", _reads(F.col("at") + 1))
        frontier = staged(step.select("word", after.alias("s")).where("s is not null").select("word", "s.at", "s.node", "s.done"),
                          f"{name}-frontier")
        found.append(frontier.where("done").select("word", "node"))
    ends = found[0]
    for f in found[1:]:
        ends = ends.union(f)
    near = ends.distinct().join(vocabulary.select(F.col("word").alias("near"), _end("word").alias("node")).hint(SORTED), "node")
    if backwards:
        near = near.select(F.reverse("word").alias("word"), F.reverse("near").alias("near"))
    return near.where(F.levenshtein("word", "near", 1) == 1).select("word", "near")


# ------------------------------------------------------------------ variants

def variants(vocabulary: DataFrame, min_chars: int = 6, ratio: int = 5, name: str = "spelling") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``vocabulary`` (word, n).

    ``form`` is the near word of largest n (ties: smallest word) if that n is at
    least ``ratio`` times the word's, else null; ``root`` follows forms to the
    last. Words must be distinct, with at least ``min_chars`` code points (2 at
    least). No words: no rows.
    """
    vocabulary = staged(vocabulary.select("word", "n"), f"{name}-vocabulary")
    least = min_chars // 2
    pairs = staged(neighbours(vocabulary, least, False, name).union(neighbours(vocabulary, least, True, name)).distinct(), f"{name}-near")
    best = (pairs.join(vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")).hint(SORTED), "near")
            .groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), "near")).alias("best")))
    is_form = -F.col("best.minus") >= ratio * F.col("n")
    rows = staged(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(is_form, F.col("best.near")).alias("form"),
        F.when(is_form, -F.col("best.minus")).alias("form_n")), f"{name}-forms")
    # Counts grow at least ``ratio`` times with each form, so ways are short; every turn doubles the part walked.
    ways = rows.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        onward = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        ways = staged(ways.join(onward.hint(SORTED), "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                                F.col("next").isNotNull().alias("moved")), f"{name}-roots")
        if ways.where("moved").isEmpty():
            break
        ways = ways.select("word", "root")
    return rows.join(ways.select("word", "root").hint(SORTED), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
