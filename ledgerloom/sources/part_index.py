"""Which part folders can hold a key: their least and greatest key and a Bloom filter.

History grows by part folders and a batch names few of its keys. Before the
history is read, the batch's keys are held against an index of the parts: a
part's filter as bitmaps of 32,768 bits, each with the bounds of its keys. A
part is read if some key lies within the bounds and meets a set bit; one that
holds a key is never left out. Bits follow the part's rows, so filters do not fill up
as parts grow. Index and search are Spark's own bitmap functions and joins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = 32_768           # bits of one bitmap, as Spark's bitmap functions cut them
BITS_A_ROW = 16         # about 6 % of foreign keys meet a set bit
INDEX = "path string, key string, low string, high string, bits long, word long, filter binary"


def _bit(key: Column, bits: Column) -> Column:
    """The key's position among ``bits``, from 1 as the bitmap functions count."""
    return F.pmod(F.xxhash64(key.cast("string")), bits) + 1


def index_parts(parts: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """The index rows of parts: ``parts`` holds their rows and each row's part in ``path``.

    ``rows`` (a part's usual row count) sets the filters' size. Bounds compare as
    text. Null keys are not indexed: an equality finds none.
    """
    bits = max(1, -(-rows * BITS_A_ROW // WORD)) * WORD
    out = None
    for key in keys:
        known = parts.where(F.col(key).isNotNull()).select("path", F.col(key).cast("string").alias("k"))
        at = _bit(F.col("k"), F.lit(bits))
        words = known.groupBy("path", F.bitmap_bucket_number(at).alias("word")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("filter"),
            F.min("k").alias("low"), F.max("k").alias("high"))
        # A part's bounds are on each of its rows: bounds of the keys in that bitmap cut a little more.
        own = words.select("path", F.lit(key).alias("key"), "low", "high", F.lit(bits).cast("long").alias("bits"), "word", "filter")
        out = own if out is None else out.unionByName(own)
    return out


def index_part(part: DataFrame, path: str, keys: Sequence[str], rows: int) -> DataFrame:
    """The index rows of one part."""
    return index_parts(part.withColumn("path", F.lit(path)), keys, rows)


def parts_with(index: DataFrame, asked: DataFrame, key: str, column: str | None = None) -> list[str]:
    """Paths of the parts that may hold a key of ``asked`` (one row a part comes back)."""
    column = column or key
    of_key = index.where(F.col("key") == key)
    sizes = of_key.select("bits").distinct()
    keys = asked.where(F.col(column).isNotNull()).select(F.col(column).cast("string").alias("k")).distinct()
    # Parts of one size share their positions: keys are placed once a size, of which there are few.
    at = _bit(F.col("k"), F.col("bits"))
    placed = keys.crossJoin(F.broadcast(sizes)).select(
        "k", "bits", F.bitmap_bucket_number(at).alias("word"), F.bitmap_bit_position(at).alias("bit"))
    byte = F.conv(F.hex(F.expr("substring(filter, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0
    met = placed.join(of_key, ["bits", "word"]).where(F.col("k").between(F.col("low"), F.col("high")) & hit)
    return sorted(r["path"] for r in met.select("path").distinct().collect())


def read_index(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.schema(INDEX).parquet(*paths) if paths else spark.createDataFrame([], INDEX)
