"""The registered queries of this subpackage: each applies an operator to its whole table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (chat_tree, decontaminate, fingerprint, line_dedup, merkle, mixing, packing, quality, simhash,
                            spelling, sql, suffix_dedup, toxicity, url_filter)
from ledgerloom.llm.shared import raw_bytes, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, radius=4).select(
        "doc_id", "fingerprint", "component_id")


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"), length=400).select(
        "doc_id", "n_bytes", "n_removed", F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), "kept_sha256",
        (F.col("n_removed") > 0).alias("has_repeats"))


# (verdict, host, path): fixed values.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    index = url_filter.mine_rules(pages, table(spark, sf_dir, "labels"))
    return url_filter.judge(pages, index, URL_RULES)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.posterior(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    bitmaps = line_dedup.keep_bitmaps(docs, min_docs=10, min_chars=1)

    def digest(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            counts, hashes = [], []
            for text, keep in zip(raw_bytes(batch.column(1)), batch.column(2).to_pylist()):
                text = text or b""
                counts.append(text.count(b"\n") + 1)
                hashes.append(hashlib.sha256(line_dedup.kept_text(text, keep)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), batch.column(3), pa.array(hashes)],
                ["doc_id", "n_lines", "n_dropped", "kept_sha256"])

    marked = line_dedup.with_bitmaps(docs, bitmaps).select(
        "doc_id", "text", "__llm_keep", F.coalesce("__llm_dropped", F.lit(0)).cast("long").alias("n_dropped"))
    return marked.mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def op7_chat_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(own)
    return chat_tree.digests(chat_tree.packs(turns))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_comparison(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.train(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(packing.pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, capacity=2048, end_id=0), capacity=2048)


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.words(table(spark, sf_dir, "documents"), min_chars=6, min_count=5, noise=199)
    return spelling.variants(found, min_chars=6, ratio=5)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    leaves = merkle.document_leaves(docs, tampered, lambda text: text.replace(b"\n", b""))
    return merkle.fold(merkle.manifest(leaves)).withColumnRenamed("carried", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_url_filter": op3_url_filter,
    "op4_quality": op4_quality,
    "op5_mixing": op5_mixing,
    "op6_line_dedup": op6_line_dedup,
    "op7_chat_tree": op7_chat_tree,
    "op8_fingerprints": op8_fingerprints,
    "op9_decontaminate": op9_decontaminate,
    "op10_toxicity": op10_toxicity,
    "op11_packing": op11_packing,
    "op12_spelling": op12_spelling,
    "op13_merkle": op13_merkle,
}
ORACLE: dict[str, str] = {
    "op6_line_dedup": sql.LINE_DEDUP,
    "op7_chat_tree": sql.CHAT_TREE,
    "op12_spelling": sql.SPELLING,
    "op13_merkle": sql.MERKLE,
}
