"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded digest within their source, and a row of rank r among the n rows of its source
gets the fractional rank (2r + 1) / 2n. Ordered by it, every stretch of the sequence holds the sources in
the proportions of the whole, so equal cuts give shards that match the mixture to within one row per
source, with row counts at most one apart.

No window holds a whole source or the whole table: ranks are counted inside bounded buckets of the digest (of
the fractional rank) and moved by the running count of the buckets before. The texts are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SHARDS = 8
SEED = "17"
BUCKET_ROWS = 4096


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    seed: str = SEED,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """``docs`` with doc_id, size, text_crc32, law, shard, slot and grown_shard.

    A null text has size 1 and the checksum of no bytes; an empty text likewise. A null source is a source of
    its own, a null doc_id counts as an empty one. Repeated rows are rows of their own; rows that agree in
    doc_id, checksum and size are interchangeable. An empty table gives no rows. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 1).cast("long")
    checksum = F.crc32(F.encode(text, "UTF-8"))
    # Of all that tells rows apart, so that rows without an id or with the same one are spread too.
    name = F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), checksum, size)
    digest = F.md5(F.encode(name, "UTF-8"))
    total = docs.count()
    buckets = max(1, -(-total // bucket_rows))
    rows = docs.select(
        "doc_id",
        F.when(F.col("source").isNull(), "n")
        .otherwise(F.concat(F.lit("s"), F.col("source")))
        .alias("__source"),
        size.alias("size"),
        checksum.alias("text_crc32"),
        digest.alias("__digest"),
    )
    order = ["__digest", "doc_id", "text_crc32", "size"]
    high = F.conv(F.substring("__digest", 1, 8), 16, 10).cast("long")
    ranked = _ranked(rows.withColumn("__bucket", F.floor(high * buckets / 2**32)), "__source", order)
    # Equal fractions of two sources are equal as doubles: both are the same quotient, rounded once.
    fraction = (2 * F.col("__rank") + 1) / (2 * F.col("__rows"))
    spread = ranked.withColumn("__fraction", fraction).drop("__rank", "__rows")
    spread = spread.withColumn(
        "__bucket", F.least(F.floor(F.col("__fraction") * buckets), F.lit(buckets - 1))
    ).withColumn("__all", F.lit(0))
    placed = _ranked(spread, "__all", ["__fraction", "__source", *order])
    number = F.floor(F.col("__rank") * shards / F.col("__rows"))
    start = F.ceil(F.col("shard") * F.col("__rows") / shards)
    return placed.withColumn("shard", number.cast("int")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        (F.col("__rank") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _ranked(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``rows`` with their ``__rank`` from 0 within ``key`` and the ``__rows`` of that key.

    ``__bucket`` must ascend with ``order``; a task ranks the rows of one bucket. The running counts have one
    row per key and bucket, and the join keeps the partitioning of the ranking.
    """
    of_key = W.partitionBy(key)
    before = of_key.orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        rows.groupBy(key, "__bucket")
        .agg(F.count("*").alias("__n"))
        .withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .withColumn("__rows", F.sum("__n").over(of_key))
        .drop("__n")
    )
    within = F.row_number().over(W.partitionBy(key, "__bucket").orderBy(*order)) - 1
    return (
        rows.withColumn("__within", within)
        .join(offsets, [key, "__bucket"])
        .withColumn("__rank", F.col("__within") + F.col("__before"))
        .drop("__within", "__before", "__bucket")
    )
