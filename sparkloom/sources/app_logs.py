"""The log table: a fixture view over ``events``, keyset pages, backlog, JDBC and file scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..schema import RAW

#: Text for Spark and DuckDB alike.
FIXTURE_SQL = """select
  event_id + 1 as id,
  case when event_id % 17 = 0 then ts - interval '2' hour else ts end as ts,
  case when event_type = 'error' and event_id % 4 = 0 then 'SEVERE' when event_type = 'error' then 'notice' when event_type = 'purchase' then 'info'
       when event_type = 'signup' then ' Warning ' when event_type = 'click' then 'debug' else null end as level,
  case when event_type = 'error' then 'payment-api' when event_type = 'purchase' then 'checkout-svc'
       when event_type = 'signup' then 'auth-svc' when event_type = 'click' then 'catalog-svc' else null end as service,
  case when event_id % 6 = 0 then concat('op=', event_type, ' user=', cast(user_id as varchar(20)), ' traceId=t-', cast(event_id as varchar(20)))
       when event_id % 6 = 1 then concat('slow call msg="a b" thread=w1 status=', cast(200 + event_id % 3 as varchar(20)))
       when event_id % 6 = 2 then concat('[pool-', cast(event_id % 4 as varchar(20)), '] java.sql.SQLException: code ', cast(event_id as varchar(20)))
       when event_id % 6 = 3 then concat('{"level":"warn","user":', cast(user_id as varchar(20)), ',"context":{"requestId":"r-', cast(event_id as varchar(20)), '","k":1.50},"tags":[1,2],"x":null}')
       when event_id % 6 = 4 and event_id % 5 = 0 then '{"a": }'
       else concat('plain text ', cast(event_id as varchar(20)), ' session=s', cast(event_id % 9 as varchar(20))) end as message,
  case when event_id % 5 = 0 then null else user_id end as user_id,
  case when event_type = 'signup' then concat('198.51.100.', cast(event_id % 3 as varchar(20)))
       else concat('10.0.', cast(cast(floor(user_id / 256) as bigint) as varchar(20)), '.', cast(user_id % 256 as varchar(20))) end as ip,
  cast(case when event_id % 6 in (1, 2) and event_id % 5 = 0 then null
       when ts >= timestamp '2024-01-20 00:00:00' and ts < timestamp '2024-01-22 00:00:00' and event_id % 10 < 9 then 503
       when event_type = 'error' and event_id % 4 = 0 then 500
       when event_type = 'signup' then 401
       when event_type = 'click' and event_id % 11 = 0 then 429
       when event_type = 'view' and event_id % 7 = 0 then 404 else 200 end as int) as status_code,
  cast(floor(value * 10) as bigint) as latency_ms,
  case when event_type = 'error' then concat(
       case when event_id % 3 = 0 then 'java.lang.NullPointerException' when event_id % 3 = 1 then 'java.lang.IllegalStateException' else 'java.io.IOException' end,
       chr(10), chr(9), 'at com.app.A.a(A.java:', cast(event_id as varchar(20)), ')', chr(10), chr(9), 'at com.app.B.b(B.java:', cast(event_id + 7 as varchar(20)), ')',
       chr(10), chr(9), 'at com.app.C$$Lambda$', cast(event_id as varchar(20)), '/0xabc', cast(event_id as varchar(20)), '.run(C.java:1)') else null end as stack_trace
from events"""


def fixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log table derived from the ``events`` table of a test directory."""
    spark.read.parquet(f"{sf_dir}/events.parquet").createOrReplaceTempView("sparkloom_events")
    return spark.sql(FIXTURE_SQL.replace("from events", "from sparkloom_events"))


def spread(raw: DataFrame) -> DataFrame:
    """Deals a table with fewer splits than the cluster has cores over all of them, as parsing is
    work for the processor; a larger one stays as it is."""
    cores = raw.sparkSession.sparkContext.defaultParallelism
    return raw.repartition(cores) if raw._jdf.queryExecution().toRdd().getNumPartitions() < cores // 2 else raw


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def read_jdbc(spark: SparkSession, c: Config, table: str = "app_logs", low: int = 0, high: int | None = None, parts: int = 8) -> DataFrame:
    """The table over JDBC, split by ranges of its key; the driver's jar must be on the class path."""
    reader = spark.read.format("jdbc").option("url", c.db_url).option("user", c.db_user).option("password", c.db_password).option("dbtable", table)
    if high is not None:
        reader = reader.option("partitionColumn", "id").option("lowerBound", low).option("upperBound", high).option("numPartitions", parts)
    return reader.load().where(F.col("id") > low)


def page(raw: DataFrame, cursor: int, size: int) -> DataFrame:
    """The next ``size`` rows after the cursor, by id."""
    return raw.where(F.col("id") > cursor).orderBy("id").limit(size)


def after(raw: DataFrame, cursor: int) -> DataFrame:
    """All rows after the cursor: a catch-up run reads them at once and numbers its batches."""
    return raw.where(F.col("id") > cursor)


def backlog(raw: DataFrame, cursor: int) -> DataFrame:
    """The gap from the cursor to the largest id, 0 at least."""
    return raw.agg(F.greatest(F.lit(0).cast("long"), F.max("id") - F.lit(cursor)).alias("backlog"))
