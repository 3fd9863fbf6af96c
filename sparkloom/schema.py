"""Fixed schemas of the data flow."""

from pyspark.sql import types as T

RAW = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("level", T.StringType()), T.StructField("service", T.StringType()), T.StructField("message", T.StringType()),
    T.StructField("user_id", T.LongType()), T.StructField("ip", T.StringType()), T.StructField("status_code", T.IntegerType()), T.StructField("latency_ms", T.LongType()), T.StructField("stack_trace", T.StringType()),
])

#: Columns of a delivered document, in the order of its JSON text.
DOCUMENT = T.StructType([
    T.StructField("@timestamp", T.StringType()), T.StructField("level", T.StringType()), T.StructField("service", T.StringType()), T.StructField("message", T.StringType()), T.StructField("sourceId", T.LongType()),
    T.StructField("userId", T.LongType()), T.StructField("ip", T.StringType()), T.StructField("statusCode", T.IntegerType()), T.StructField("latencyMs", T.LongType()), T.StructField("stackTrace", T.StringType()),
    T.StructField("category", T.StringType()), T.StructField("domain", T.StringType()), T.StructField("severity", T.StringType()), T.StructField("fingerprint", T.StringType()), T.StructField("traceId", T.StringType()),
    T.StructField("synthetic", T.BooleanType()), T.StructField("enrichment", T.MapType(T.StringType(), T.StringType())), T.StructField("fields", T.MapType(T.StringType(), T.StringType())),
])

PARSE_DEAD_LETTER = "source_id long, raw_message string, reason string, failed_at timestamp"
INDEX_DEAD_LETTER = "es_id string, target_index string, http_status int, reason string, body string, failed_at timestamp"
