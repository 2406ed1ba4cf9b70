"""Contiguous shards of nearly equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, table

ROW_BYTES = 16


def shard(df: DataFrame, size: Column, order: list[Column], shards: int = 40) -> DataFrame:
    """df with size, shard (0 to shards-1) and slot (gapless from 0 in a shard).

    Rows are dealt by range of `order`; each range has a running sum, the ranges' totals (one row each) give every
    range its global offset, and a row goes to the shard in whose equal share of all bytes its middle byte lies.
    Sizes differ by a row or two. Repeated rows are told apart by a row number that follows the input's order, so a
    third of all rows with one key is still split. Null order keys come first; an empty table gives no rows. Columns that
    clash (size, shard, slot) are replaced, after size and order are taken from them.
    `df` should hold no more columns than are to be returned: they are dealt once and sorted in ranges.
    """
    parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), shards)
    sized = df.select("*", size.alias("__size"), F.monotonically_increasing_id().alias("__mid"), *[o.alias(f"__order{i}") for i, o in enumerate(order)])
    keyed, order = sized.drop("size", "shard", "slot"), [F.col(f"__order{i}") for i in range(len(order))]
    keys = [*order, F.col("__mid")]
    ranged = cut(keyed.repartitionByRange(parts, *keys).withColumn("__pid", F.spark_partition_id()), "shard-ranges")
    w = Window.partitionBy("__pid").orderBy(*keys)
    run = ranged.select("*", F.sum("__size").over(w).alias("__run"), F.row_number().over(w).cast("long").alias("__rn"))
    totals = ranged.groupBy("__pid").agg(F.sum("__size").alias("__bytes"))
    # one row for each range: at most `parts` rows
    offsets = totals.select("__pid", (F.sum("__bytes").over(Window.orderBy("__pid")) - F.col("__bytes")).alias("__before"), F.sum("__bytes").over(Window.partitionBy(F.lit(0))).alias("__all"))
    middle = 2 * (F.col("__before") + F.col("__run")) - F.col("__size")
    placed = cut(
        run.join(F.broadcast(offsets), "__pid")
        .withColumn("shard", F.least(F.lit(shards - 1), F.when(F.col("__all") > 0, F.floor(middle.cast("decimal(38,0)") * shards / (2 * F.col("__all")))).otherwise(0)).cast("int"))
        .drop("__run", "__before", "__all", "__mid"),
        "shard-placed",
    )
    # a range meets consecutive shards only: at most parts + shards rows
    pieces = placed.groupBy("__pid", "shard").agg(F.min("__rn").alias("__first"), F.count("*").alias("__n"))
    pieces = pieces.withColumn("__ahead", F.sum("__n").over(Window.partitionBy("shard").orderBy("__pid")) - F.col("__n")).drop("__n")
    return placed.join(F.broadcast(pieces), ["__pid", "shard"]).withColumn("slot", F.col("__ahead") + F.col("__rn") - F.col("__first")).withColumnRenamed("__size", "size").drop("__pid", "__rn", "__first", "__ahead", *[f"__order{i}" for i in range(len(order))])


def text_size(text: Column) -> Column:
    return (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long")


def op3_sharding(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", text_size(F.col("text")).alias("bytes"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    out = shard(docs, F.col("bytes"), [F.col("doc_id"), F.col("text_crc32"), F.col("bytes")])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
