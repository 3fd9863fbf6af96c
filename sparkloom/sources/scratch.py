"""Written intermediate tables in the shared folder: they cut the plan and the lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame


def settle(df: DataFrame, name: str = "t") -> DataFrame:
    """Writes ``df`` under spark.checkpoint.dir and reads it again: what is used several times is
    made once, and a lost executor costs no recomputation. A temporary folder only in local mode."""
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.mkdtemp(prefix='sparkloom-')}"
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(made)  # when the driver ends
    return spark.read.schema(df.schema).parquet(path)
