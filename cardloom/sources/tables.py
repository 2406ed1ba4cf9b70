"""Immutable tables with a manifest: written once, verified by hash and count."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def canonical(value) -> str:
    """JSON with sorted keys and no spaces; NaN is refused."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def row_digest(df: DataFrame) -> DataFrame:
    """One row: rows, and a digest that doesn't depend on order or partitions (sums of two halves of each row's hash)."""
    h = F.sha2(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}), 256)
    half = lambda i: F.sum(F.conv(F.substring(h, i, 12), 16, 10).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("rows"), F.coalesce(half(1), F.lit(0)).cast("string").alias("a"), F.coalesce(half(13), F.lit(0)).cast("string").alias("b"))


def write_immutable(df: DataFrame, path: str, key: list[str]) -> dict:
    """Write df (an existing path is an error), refuse repeated keys, and give its manifest."""
    if not df.groupBy(*key).count().where("count > 1").isEmpty():
        raise ValueError(f"repeated rows by {key}")
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    return manifest(df.sparkSession, path)


def manifest(spark: SparkSession, path: str) -> dict:
    r = row_digest(spark.read.parquet(path)).first()
    body = {"path": path, "rows": r.rows, "digest": hashlib.sha256(f"{r.rows}:{r.a}:{r.b}".encode()).hexdigest(), "schema": spark.read.parquet(path).schema.simpleString()}
    return body | {"id": hashlib.sha256(canonical(body).encode()).hexdigest()}


def verify(spark: SparkSession, expected: dict) -> bool:
    return manifest(spark, expected["path"]) == expected


def verify_objects(objects: DataFrame, expected: DataFrame) -> DataFrame:
    """path and code for raw objects(path, bytes, sha256) that are missing, unexpected or differ from expected."""
    j = objects.alias("o").join(expected.alias("e"), "path", "full_outer")
    code = F.when(F.col("o.sha256").isNull(), "integrity.object_missing").when(F.col("e.sha256").isNull(), "integrity.object_unexpected").when(F.col("o.bytes") != F.col("e.bytes"), "integrity.size_mismatch").when(F.col("o.sha256") != F.col("e.sha256"), "integrity.sha256_mismatch")
    return j.select("path", code.alias("code")).where("code is not null")


def quarantine(records: DataFrame, id_column: str) -> tuple[DataFrame, DataFrame]:
    """records(.., findings): those without findings, and (id, code) of the others; nothing is dropped silently."""
    return records.where(F.size("findings") == 0), records.where(F.size("findings") > 0).select(id_column, F.explode("findings").alias("code"))
