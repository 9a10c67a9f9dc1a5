"""Document fingerprints: one-permutation MinHash with optimal densification.

Every shingle hash is used once: its high bits choose a bin, the rest is its
value, and a bin keeps its least value. An empty bin takes the value of a full
bin that a hash of (bin, attempt) chooses, so two documents fill an empty bin
alike with the chance of their similarity. Of each value the low ``bits`` bits
are packed; the chance that unequal values share them is taken out of the
estimate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.shared import WordHashes, lower_words, mixed, staged, word_shingles

BINS, BITS = 512, 4


class Sketcher:
    """Makes sketches; holds each bin's own random order of the bins and the hashes of words met."""

    def __init__(self, shingle_words: int = 5, bins: int = BINS, bits: int = BITS):
        self.shingle_words, self.bins, self.bits = shingle_words, bins, bits
        keys = mixed(np.arange(bins * bins, dtype=np.uint64) + np.uint64(1)).reshape(bins, bins)
        order = np.argsort(keys, axis=1)
        self.steps, self.rank = order[:, :8].copy(), np.argsort(order, axis=1).astype(np.uint16)
        self.salt = np.arange(bins, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        self.hashes = WordHashes()

    def densified(self, values: np.ndarray, full: np.ndarray) -> np.ndarray:
        """Fill each empty bin from the first full bin in its own order of the bins."""
        empty = np.flatnonzero(~full)
        if not len(empty):
            return values
        source, present = np.full(len(empty), -1), np.flatnonzero(full)
        if len(present) > 64:  # mostly found within a few steps
            near = self.steps[empty]
            hits = full[near]
            first = hits.argmax(axis=1)
            rows = np.arange(len(empty))
            source = np.where(hits[rows, first], near[rows, first], -1)
        open_ = np.flatnonzero(source < 0)
        source[open_] = present[self.rank[np.ix_(empty[open_], present)].argmin(axis=1)]
        out = values.copy()
        out[empty] = values[source]
        return out

    def __call__(self, text: bytes) -> np.ndarray:
        """The low-order bits of each bin's value; no words: no bins."""
        h = word_shingles(lower_words(text), self.shingle_words, self.hashes)
        if not len(h):
            return np.empty(0, np.uint8)
        h.sort()
        where = (h >> np.uint64(64 - (self.bins.bit_length() - 1))).astype(np.int64)
        first = np.flatnonzero(np.diff(where, prepend=-1))
        low = np.zeros(self.bins, np.uint64)
        low[where[first]] = h[first]
        full = np.zeros(self.bins, bool)
        full[where[first]] = True
        # The bin enters too: else texts of very few shingles, whose bins hold one value, would
        # share the low bits of all bins or of none.
        return mixed(self.densified(low, full) ^ self.salt).astype(np.uint8) & np.uint8((1 << self.bits) - 1)


def packed(values: np.ndarray, bits: int = BITS) -> bytes:
    """``bits`` bits a bin, first bin in the lowest."""
    return np.packbits(np.unpackbits(values[:, None], axis=1, bitorder="little")[:, :bits].ravel(),
                       bitorder="little").tobytes() if len(values) else b""


def unpacked(data: bytes, bits: int = BITS) -> np.ndarray:
    rows = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little").reshape(-1, bits)
    return np.packbits(rows, axis=1, bitorder="little").ravel()


def likeness(a: np.ndarray, b: np.ndarray, bits: int = BITS) -> float:
    """The similarity that two sketches show, without the chance agreement of their few bits."""
    if not len(a) or not len(b):
        return 1.0 if len(a) == len(b) else 0.0
    chance = 0.5 ** bits
    return min(1.0, max(0.0, (np.count_nonzero(a == b) / len(a) - chance) / (1 - chance)))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                 bins: int = BINS, bits: int = BITS) -> DataFrame:
    """``(doc_id, fingerprint binary)`` for every row.

    Shingles are runs of ``shingle_words`` words, A-Z lower-cased; a shorter text
    is one shingle. Null, empty and blank texts have an empty fingerprint, like
    each other and unlike all else. Equal texts have equal fingerprints; ids may
    be null or repeated; other columns are ignored.
    """
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = Sketcher(shingle_words, bins, bits)
        for batch in rows:
            made = [packed(sketch(t or b""), bits)
                    for t in batch.column(1).cast(pa.binary()).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["doc_id", "fingerprint"])

    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, fingerprint binary"))


def edited(text: str, following: str) -> str:
    """``text`` whose last quarter gives way to as much of the next document's start."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


_COMPARED = ("doc_id long, n_chars long, edited_sha256 binary, fingerprint binary, "
             "edited_fingerprint binary, near_edited double, near_next double")
_SCHEMA = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("n_chars", pa.int64()),
                     ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()),
                     ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()),
                     ("near_next", pa.float64()), ("text", pa.string())])
ROW, HEAD, TAIL = 0, 1, 2


def _compared(doc_id: int | None, text: str, own: np.ndarray, following: str, after: np.ndarray,
              make: Callable[[str], np.ndarray], bits: int) -> tuple:
    changed = edited(text, following)
    other = own if changed == text else make(changed)
    return (doc_id, len(text), hashlib.sha256(changed.encode()).digest(), packed(own, bits),
            packed(other, bits), likeness(own, other, bits), likeness(own, after, bits))


def edit_comparison(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5,
                    bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Each document's fingerprint beside those of its edited text and of the next document.

    Documents follow by ascending id (null first; rows that share an id by
    text), the first after the last; a single row follows itself. Ranges of ids
    are streamed in order, so a task holds two texts. The last row of a range
    needs the first of the next one: each range hands these two on, and a join
    of one row a range settles them. Null texts count as empty; an empty table
    gives no rows; other columns are ignored.
    """
    def maker() -> Callable[[str], np.ndarray]:
        sketch = Sketcher(shingle_words, bins, bits)
        return lambda t: sketch(t.encode())

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    def stream(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, out, make = None, [], None
        for batch in rows:
            make = make or maker()
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                own = make(text)
                if before is None:
                    out.append((HEAD, doc_id, None, None, packed(own, bits), None, None, None, text))
                else:
                    out.append((ROW, *_compared(*before, text, own, make, bits), None))
                before = (doc_id, text, own)
                if len(out) >= 256:
                    yield pack(out)
                    out = []
        if before is not None:
            out.append((TAIL, before[0], None, None, packed(before[2], bits), None, None, None, before[1]))
        if out:
            yield pack(out)

    narrow = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                         F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    made = staged(narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
                  .mapInArrow(stream, f"kind int, {_COMPARED}, text string"), "fingerprints")

    # A range of one row has a head and a tail of the same id: its head comes first.
    ends = made.where("kind > 0").select("kind", "doc_id", "fingerprint", F.length("text").alias("n"))
    # One narrow row or two for each partition: their order fits a single task at any size.
    ordered = Window.orderBy(F.col("doc_id").asc_nulls_first(), "kind")
    place = ends.withColumn("at", F.row_number().over(ordered))
    last = F.when(F.col("kind") == TAIL, F.col("at") + 1)
    count = place.agg(F.max("at")).first()[0] or 0
    tails = place.where(f"kind = {TAIL}").select("doc_id", F.when(F.col("at") == count, 1).otherwise(last).alias("next_at"))
    heads = place.where(f"kind = {HEAD}").select(F.col("doc_id").alias("next_id"), F.col("at").alias("next_at"))
    follows = tails.join(heads, "next_at")

    def finish(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, read = None, lambda x: unpacked(x, bits)
        for batch in rows:
            make = make or maker()  # most tasks have no such row
            done = [(ROW, *_compared(doc_id, text, read(own), after_text, read(after), make, bits), None)
                    for doc_id, text, own, after_text, after in zip(*(c.to_pylist() for c in batch.columns))]
            yield pa.RecordBatch.from_arrays(pack(done).columns[1:8], names=_SCHEMA.names[1:8])

    tail_rows = made.where(f"kind = {TAIL}").select("doc_id", "text", "fingerprint")
    head_rows = made.where(f"kind = {HEAD}").select(F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"),
                                                    F.col("fingerprint").alias("next_fingerprint"))
    follows = follows.withColumnRenamed("doc_id", "tail_id").withColumnRenamed("next_id", "head_id")
    met = (tail_rows.join(follows, F.col("doc_id").eqNullSafe(F.col("tail_id")))
           .join(head_rows, F.col("head_id").eqNullSafe(F.col("next_id")))
           .select("doc_id", "text", "fingerprint", "next_text", "next_fingerprint"))
    columns = [f.split()[0] for f in _COMPARED.split(", ")]
    # Written as bytes, shown as hexadecimal digits.
    digits = {"edited_sha256", "fingerprint", "edited_fingerprint"}
    return (made.where(f"kind = {ROW}").select(*columns).union(met.mapInArrow(finish, _COMPARED))
            .select(*[F.lower(F.hex(c)).alias(c) if c in digits else F.col(c) for c in columns]))
