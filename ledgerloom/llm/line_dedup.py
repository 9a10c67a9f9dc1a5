"""Line dedup: range-partitioned hashes, streamed in order, answered with keep bitmaps.

Each document gives one narrow row per distinct line key: a 128-bit hash and
the line positions. The rows are range-partitioned by (hash, document, text) and
sorted, so a task streams each key's documents in order and holds at most
``min_docs`` rows of a key; repeated rows are passed over. A key with very many
documents, or an id with very many texts, spreads over several partitions: what
a partition cannot decide alone concerns its first and last key, and keys of
which one id has more texts than are held. Each partition hands on the document
counts of those, and the open rows are settled by adding the counts up.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.shared import free, raw_bytes, staged

BLANK = b" \t\n\r\x0b\x0c"
_LINES = "h1 long, h2 long, doc_id long, text_key long, n_lines int, positions array<int>"
_EVENTS = f"kind int, {_LINES}, docs long, leads boolean"
DROP, OPEN, EDGE = 0, 1, 2


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.xxhash64(F.col(f"`{text_col}`")).alias("text_key"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def line_keys(text: bytes, min_chars: int = 1) -> dict[bytes, list[int]]:
    """The positions of each line key of at least ``min_chars`` code points."""
    found: dict[bytes, list[int]] = {}
    for at, line in enumerate(text.lower().split(b"\n")):
        key = line.strip(BLANK)
        if len(key) >= min_chars and (min_chars <= 1 or len(key.decode()) >= min_chars):
            found.setdefault(key, []).append(at)
    return found


def _to_lines(min_chars: int):
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()),
                            ("text_key", pa.int64()), ("n_lines", pa.int32()), ("positions", pa.list_(pa.int32()))])
        seen: set[tuple] = set()  # repeated rows need not travel; those missed here are passed over later
        for batch in rows:
            hashes, owner, counts, places = [], [], [], []
            names = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            for i, (name, text) in enumerate(zip(names, raw_bytes(batch.column(2)))):
                if name in seen:
                    continue
                if len(seen) >= 1 << 16:
                    seen.clear()
                seen.add(name)
                own = line_keys(text, min_chars)
                hashes += map(xxhash.xxh3_128_digest, own)
                places += own.values()
                owner += [i] * len(own)
                counts += [text.count(b"\n") + 1] * len(own)
            pair = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
            owner = pa.array(owner, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(pair[:, 0]), pa.array(pair[:, 1]), batch.column(0).take(owner),
                 batch.column(1).take(owner), pa.array(counts, pa.int32()),
                 pa.array(places, pa.list_(pa.int32()))], schema=schema)
    return run


def _stream(min_docs: int, keep_first: bool):
    """Decide the rows of each key of one sorted partition; see the module's text."""
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        schema = pa.schema([("kind", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("doc_id", pa.int64()),
                            ("text_key", pa.int64()), ("n_lines", pa.int32()),
                            ("positions", pa.list_(pa.int32())), ("docs", pa.int64()), ("leads", pa.bool_())])

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
            out.clear()
            return made

        def drop(row: tuple, leads: bool) -> None:
            if not (leads and keep_first):
                out.append((DROP, *row, 0, False))
            elif len(row[5]) > 1:
                out.append((DROP, *row[:5], row[5][1:], 0, False))

        def settle(last: bool) -> None:
            edge = first_run or last or spilled
            if edge:
                # The first and last document may go on in other partitions; those between do not.
                out.append((EDGE, *key, *first_doc, 0, [], max(0, docs - 2), False))
                out.append((EDGE, *key, *before[2:], 0, [], 0, False))
            if docs < min_docs:
                if edge:
                    out.extend((OPEN, *row, 0, leads) for row, leads in held)
            elif keep_first and first_run and lead is not None:
                out.append((OPEN, *lead, 0, True))

        key, docs, held, lead, first_run, first_doc, seen = None, 0, [], None, True, None, None
        before, spilled = None, False
        for rows_in in rows:
            columns = [rows_in.column(i).to_pylist() for i in range(6)]
            for row in zip(*columns):
                if row[:4] == before:
                    continue
                if row[:2] != key:
                    if key is not None:
                        settle(False)
                        first_run = False
                    key, docs, held, lead, first_doc, seen = row[:2], 0, [], None, row[2:4], object()
                    spilled = False
                before = row[:4]
                leads = docs == 0
                if row[2] != seen:
                    docs, seen = docs + 1, row[2]
                if docs < min_docs:
                    held.append((row, leads))
                    if len(held) > min_docs:  # many texts of one id
                        out.extend((OPEN, *old, 0, old_leads) for old, old_leads in held)
                        held, spilled = [], True
                else:
                    # Over the threshold: the held rows go too, then all that follow.
                    for old, old_leads in held:
                        if old_leads and keep_first and first_run:
                            lead = old  # an earlier partition may hold the first one
                        else:
                            drop(old, old_leads)
                    held = []
                    if leads and keep_first and first_run:
                        lead = row
                    else:
                        drop(row, leads)
            if len(out) >= 1 << 14:
                yield batch()
        if key is not None:
            settle(True)
        if out:
            yield batch()
    return run


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 10,
                 min_chars: int = 1, keep_first: bool = False) -> DataFrame:
    """``(doc_id, text_key, n_lines, n_dropped, keep)`` for each document that loses lines.

    Lines are split at \\n; a key is the line stripped of [\\x20\\x09-\\x0D] with
    A-Z lower-cased. Keys of at least ``min_chars`` code points found in at
    least ``min_docs`` documents lose all their lines; with ``keep_first`` the
    first line (by id, then position) stays. ``keep`` is a zlib-compressed bit
    per line, first line in the highest bit. A document without a row keeps
    every line.

    Null and empty texts are one empty line, which stays. Rows that share an
    id, repeated rows among them, count as one document, as do all rows with a
    null id; ``text_key`` tells their texts apart. Other columns are ignored.
    """
    lines = staged(_identified(docs, id_col, text_col).mapInArrow(_to_lines(min_chars), _LINES), "lines")
    order = ["h1", "h2", "doc_id", "text_key"]
    events = staged(lines.repartitionByRange(*order).sortWithinPartitions(*order)
                    .mapInArrow(_stream(min_docs, keep_first), _EVENTS), "line-events")
    edges = (events.where(f"kind = {EDGE}").groupBy("h1", "h2")
             .agg((F.sum("docs") + F.count_distinct(F.struct("doc_id"))).alias("all_docs"),
                  F.min(F.struct(F.col("doc_id").isNotNull(), "doc_id", "text_key")).alias("least")))
    leader = (F.col("leads") & F.lit(keep_first) & F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
              & (F.col("text_key") == F.col("least.text_key")))
    settled = (events.where(f"kind = {OPEN}").join(edges, ["h1", "h2"]).where(F.col("all_docs") >= min_docs)
               .withColumn("positions", F.when(leader, F.slice("positions", 2, F.greatest(F.size("positions") - 1, F.lit(0))))
                           .otherwise(F.col("positions"))))
    columns = ["doc_id", "text_key", "n_lines", "positions"]
    dropped = (events.where(f"kind = {DROP}").select(*columns).union(settled.select(*columns))
               .groupBy("doc_id", "text_key")
               .agg(F.first("n_lines").alias("n_lines"), F.flatten(F.collect_list("positions")).alias("positions")))

    def pack(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            counts, maps = [], []
            for n, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                keep = np.ones(n, bool)
                keep[gone] = False
                counts.append(n - int(keep.sum()))
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(counts, pa.int32()), pa.array(maps, pa.binary())],
                ["doc_id", "text_key", "n_lines", "n_dropped", "keep"])

    return dropped.mapInArrow(pack, "doc_id long, text_key long, n_lines int, n_dropped int, keep binary")


def kept_text(text: bytes, keep: bytes | None) -> bytes:
    """The lines that the bitmap keeps, joined by \\n; no bitmap: the whole text."""
    if keep is None:
        return text
    lines = text.split(b"\n")
    return b"\n".join(compress(lines, np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))))


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 keep: str = "__llm_keep", dropped: str = "__llm_dropped") -> DataFrame:
    """All columns of ``docs`` plus the bitmap and the number of lines dropped, null where every line
    stays. Columns that have the two names already are replaced."""
    docs = docs.drop(keep, dropped)
    of_id, of_key, own = free(docs, "__llm_id", "__llm_key", "__llm_hash")
    right = bitmaps.select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_key),
                           F.col("keep").alias(keep), F.col("n_dropped").alias(dropped))
    left = docs.withColumn(own, F.xxhash64(F.col(f"`{text_col}`")))
    same = (left[f"`{id_col}`"].cast("long").eqNullSafe(right[of_id])
            & (left[own] == right[of_key]))
    return left.join(right.hint("shuffle_hash"), same, "left").drop(own, of_id, of_key)


def without_lines(docs: DataFrame, bitmaps: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  dropped: str = "__llm_dropped") -> DataFrame:
    """``docs`` with all columns, its texts cut to the kept lines, and ``dropped``: the number of lines
    dropped, null where the text is as it was (a column of that name is replaced)."""
    (keep_col,) = free(docs, "__llm_keep")
    marked = with_bitmaps(docs, bitmaps, id_col, text_col, keep_col, dropped)
    text_at, keep_at = marked.columns.index(text_col), marked.columns.index(keep_col)
    out = marked.drop(keep_col).schema

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            texts = [t if keep is None else kept_text(t or b"", keep)
                     for t, keep in zip(raw_bytes(batch.column(text_at)), batch.column(keep_at).to_pylist())]
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            names = list(batch.schema.names)
            del columns[keep_at], names[keep_at]
            yield pa.RecordBatch.from_arrays(columns, names)

    return marked.mapInArrow(run, out)
