"""State in folders that Spark can read: marks, dead letters, baselines.

Every table is a folder of numbered versions; a writer adds the next one and readers take the
highest complete one, so that a run that dies leaves the last version as it was.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Versions:
    """A table as numbered versions under a path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _has(self, n: int) -> bool:
        return self._fs.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={n:012d}/_SUCCESS"))

    def last(self) -> int | None:
        if not self._fs.exists(self._top):
            return None
        found = sorted((int(s.getPath().getName()[2:]) for s in self._fs.listStatus(self._top) if s.getPath().getName().startswith("v=")), reverse=True)
        return next((n for n in found if self._has(n)), None)

    def read(self, n: int | None = None) -> DataFrame | None:
        n = self.last() if n is None else n
        return None if n is None or not self._has(n) else self.spark.read.parquet(f"{self.path}/v={n:012d}")

    def write(self, df: DataFrame, n: int | None = None, keep: int = 2) -> int:
        n = (self.last() if self.last() is not None else -1) + 1 if n is None else n
        df.write.mode("overwrite").parquet(f"{self.path}/v={n:012d}")
        for old in range(max(0, n - keep - 8), n - keep + 1):
            self._fs.delete(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v={old:012d}"), True)
        return n


class Checkpoint:
    """High-water marks by pipeline; they never fall."""

    def __init__(self, spark: SparkSession, path: str):
        self.table = Versions(spark, path)

    def read(self, pipeline: str) -> int:
        found = self.table.read()
        row = None if found is None else found.where(F.col("pipeline_name") == pipeline).first()
        return 0 if row is None else row.last_processed_id

    def advance(self, pipeline: str, mark: int, **more: int) -> int:
        """Moves the mark, and with it others named ``pipeline:name``, in one write."""
        spark, found = self.table.spark, self.table.read()
        new = spark.createDataFrame([(pipeline, mark), *((f"{pipeline}:{k}", v) for k, v in more.items())], "pipeline_name string, last_processed_id long")
        rows = new if found is None else found.drop("updated_at").unionByName(new)
        self.table.write(advance(rows).withColumn("updated_at", F.current_timestamp()))
        return self.read(pipeline)


def advance(marks: DataFrame) -> DataFrame:
    """The greatest mark of each pipeline."""
    return marks.groupBy("pipeline_name").agg(F.max("last_processed_id").alias("last_processed_id"))


def upsert(old: DataFrame | None, new: DataFrame, key: str, fixed: tuple[str, ...] = ()) -> DataFrame:
    """``new`` over ``old`` by key; ``fixed`` columns keep their first value."""
    new = new.dropDuplicates([key])
    if old is None:
        return new
    rows = old.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)))
    return rows.groupBy(key).agg(*((F.min_by if c in fixed else F.max_by)(c, "_n").alias(c) for c in old.columns if c != key)).select(*old.columns)


class DeadLetters:
    """Quarantined rows by key; of a row that comes again, ``fixed`` columns stay as they were."""

    def __init__(self, spark: SparkSession, path: str, key: str, fixed: tuple[str, ...]):
        self.table, self.key, self.fixed = Versions(spark, path), key, fixed

    def add(self, rows: DataFrame) -> None:
        self.table.write(upsert(self.table.read(), rows.withColumn("failed_at", F.current_timestamp()), self.key, self.fixed))


def parse_dead_letters(spark: SparkSession, path: str) -> DeadLetters:
    return DeadLetters(spark, path, "source_id", ("failed_at",))


def index_dead_letters(spark: SparkSession, path: str) -> DeadLetters:
    return DeadLetters(spark, path, "es_id", ("target_index", "failed_at"))


class Baselines(Protocol):
    def get(self, key: str) -> float | None: ...

    def set(self, key: str, value: float) -> None: ...


class MemoryBaselines:
    def __init__(self):
        self.values: dict[str, float] = {}

    def get(self, key: str) -> float | None:
        return self.values.get(key)

    def set(self, key: str, value: float) -> None:
        self.values[key] = value


class StoredBaselines:
    """Baselines in a versioned table; a failed read is no value, a failed write is let go."""

    def __init__(self, spark: SparkSession, path: str, prefix: str = ""):
        self.table, self.prefix = Versions(spark, path), prefix

    def get(self, key: str) -> float | None:
        try:
            found = self.table.read()
            row = None if found is None else found.where(F.col("key") == self.prefix + key).first()
            return None if row is None or row.value != row.value else row.value
        except Exception:  # noqa: BLE001  a lost baseline is a cold start
            return None

    def set(self, key: str, value: float) -> None:
        try:
            new = self.table.spark.createDataFrame([(self.prefix + key, float(value))], "key string, value double")
            self.table.write(upsert(self.table.read(), new, "key"))
        except Exception:  # noqa: BLE001
            pass


def baselines(spark: SparkSession, path: str | None, prefix: str = "") -> Baselines:
    """Stored baselines if the folder can be used, else in memory."""
    if path:
        try:
            Versions(spark, path).last()
            return StoredBaselines(spark, path, prefix)
        except Exception:  # noqa: BLE001
            pass
    return MemoryBaselines()
