"""Helpers that the text operators share."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Rows that a Python function sees at once.
SLICE = 256
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, spark.checkpoint.dir. Where it is unset, a local session gets a temporary one; a cluster's executors couldn't see that, so there it is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="cardloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


@contextmanager
def tidy(spark: SparkSession):
    """Shuffle files go as soon as the query that wrote them ends: what it returns is on disk by then, or with the driver."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: the lineage ends there, and lost executors cost no recomputation."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex}"
    with tidy(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.cut_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that cut() wrote, once nothing still to be run reads them; other frames are left alone."""
    for df in tables:
        if path := df.__dict__.get("cut_path"):
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def with_text(docs: DataFrame, run, added: str, make, *more: str) -> DataFrame:
    """docs with the columns `added`, which run(texts, made, *more) gives as a row for each text; made = make(), once in each
    task. Texts are sent once, as bytes, and cut to slices of SLICE rows."""
    import pyarrow as pa

    rest, extra = [c for c in docs.columns if c != "text"], StructType.fromDDL(added).fields
    sent = docs.select(F.col("text").cast("binary").alias("text"), *rest)
    schema = StructType([*sent.schema.fields, *extra])
    kinds = to_arrow_schema(StructType(extra))

    def go(batches):
        made = make()
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                b = whole.slice(lo, SLICE)
                rows = run(b.column("text").to_pylist(), made, *(b.column(c).to_pylist() for c in more))
                for field, column in zip(kinds, zip(*rows, strict=True), strict=True):
                    b = b.append_column(field.name, pa.array(column, field.type))
                yield b

    return sent.mapInArrow(go, schema).withColumn("text", F.col("text").cast("string")).select(*docs.columns, *[f.name for f in extra])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def uniform(*parts: Column | str, seed: int) -> Column:
    """A number in [0, 1) from 52 bits of md5 of seed and parts; the same in any engine that has md5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("~")) if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
