"""Where lineage ends: tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame

#: Shuffle files go as soon as the query that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df, written under spark.checkpoint.dir and read again. Where that is unset, a local session gets a temporary folder; executors of a cluster couldn't see that, so there it is an error."""
    conf = df.sparkSession.conf
    root = conf.get("spark.checkpoint.dir", None)
    if not root:
        if not df.sparkSession.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="cardloom-")
        conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    was = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(CLEANUP, was)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that written() gave, once nothing still to be run reads them."""
    for df in tables:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(df.written_path)
        at.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(at, True)
