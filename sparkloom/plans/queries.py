"""Registered queries over the fixture, and the same in DuckDB SQL.

The fixture's density (about 330 rows a day at scale 0.01) asks for a window of a day and
batches of 250 rows; thresholds are the defaults.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..operators import analyze as A
from ..operators import delivery, documents, parse, window
from ..sources import app_logs, state
from .batch import build

CONFIG = Config(batch_size=250, window_seconds=86_400, deployment_version="v1")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    parse.prepare(spark)
    return app_logs.fixture(spark, sf_dir)


def _parsed(spark, sf_dir):
    return parse.parse(app_logs.spread(_raw(spark, sf_dir)))


def _analyzed(spark, sf_dir):
    return A.analyze(parse.events(_parsed(spark, sf_dir)))


def _flow(spark, sf_dir):
    return build(_raw(spark, sf_dir), CONFIG)


def _text(m):
    return F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ";")


def _stamp(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def level_normalize(spark, sf_dir):
    return _parsed(spark, sf_dir).select("id", "level")


def classify_counts(spark, sf_dir):
    return _analyzed(spark, sf_dir).groupBy("category", "domain", "severity").agg(F.count("*").alias("n"))


def kv_extract(spark, sf_dir):
    return parse.events(_parsed(spark, sf_dir)).where("message not like '{%'").select("id", _text(F.col("fields")).alias("pairs"))


def exception_thread(spark, sf_dir):
    return parse.events(_parsed(spark, sf_dir)).select("id", F.try_element_at("fields", F.lit("exception")).alias("exception"), F.try_element_at("fields", F.lit("thread")).alias("thread")).where("exception is not null or thread is not null")


def json_promote(spark, sf_dir):
    return parse.events(_parsed(spark, sf_dir)).where("message like '{%'").select("id", "level", "user_id", _text(F.col("fields")).alias("pairs"))


def clean_columns(spark, sf_dir):
    return parse.events(_parsed(spark, sf_dir)).select("id", _stamp("at").alias("at"), "service", "message", "user_id", "ip", "status_code", "latency_ms", "stack_trace")


def ts_fallback(spark, sf_dir):
    """Rows without a time of their own, which have one in the message in several forms, or none."""
    raw = _raw(spark, sf_dir)
    day = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    form = F.element_at(F.array(
        F.concat(F.lit("ts="), F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")), F.concat(F.lit("timestamp="), F.unix_millis(F.col("ts").cast("timestamp")).cast("string")),
        F.concat(F.lit("time="), day, F.lit("+02:00")), F.concat(F.lit("time="), day), F.lit("ts=yesterday"), F.lit("none"),
    ), (F.col("id") % 6 + 1).cast("int"))
    raw = raw.withColumn("message", form).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    return parse.parse(raw, "UTC").select("id", F.unix_millis("at").alias("at_ms"), F.col("parse_error").alias("reason"))


def dead_letters(spark, sf_dir):
    d = parse.dead_letters(_parsed(spark, sf_dir))
    return d.select("source_id", "raw_message", F.substr("reason", F.lit(1), F.lit(41)).alias("reason"))


def fingerprint_groups(spark, sf_dir):
    return _analyzed(spark, sf_dir).groupBy("fingerprint").agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def correlate(spark, sf_dir):
    return _analyzed(spark, sf_dir).where("trace_id is not null").select("id", "trace_id")


def route_index(spark, sf_dir):
    return _analyzed(spark, sf_dir).select("es_id", "target_index")


def enrich_join(spark, sf_dir):
    customer, nation = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "nation"))
    geo = nation.select(F.concat(F.lit("198.51.100."), F.col("n_nationkey").cast("string")).alias("ip"), "n_name")
    out = A.enrich(parse.events(_parsed(spark, sf_dir)), geo, customer.select("c_custkey", "c_mktsegment"), "v1")
    return out.select("id", _text(F.col("enrichment")).alias("enrichment"))


def document_json(spark, sf_dir):
    return documents.documents(A.enrich(_analyzed(spark, sf_dir), version="v1")).select("es_id", "target_index", "body")


def doc_bytes(spark, sf_dir):
    return documents.documents(A.enrich(_analyzed(spark, sf_dir), version="v1")).groupBy("target_index").agg(F.count("*").alias("n"), F.sum("n_bytes").cast("long").alias("total_bytes"), F.max("n_bytes").alias("most_bytes"))


def keyset_page(spark, sf_dir):
    return app_logs.page(_raw(spark, sf_dir), 500, 250).select("id", "service", "status_code")


def backlog(spark, sf_dir):
    return app_logs.backlog(_raw(spark, sf_dir), 500)


def checkpoint_advance(spark, sf_dir):
    batches = window.number_batches(_raw(spark, sf_dir), CONFIG.batch_size)
    marks = batches.groupBy("batch_id").agg(F.max("id").alias("last_processed_id"))
    late = marks.select((F.col("last_processed_id") - 50).alias("last_processed_id"), F.lit("app-logs").alias("pipeline_name"))
    return state.advance(marks.select("last_processed_id", F.lit("app-logs").alias("pipeline_name")).unionByName(late))


def batch_numbering(spark, sf_dir):
    return window.number_batches(_raw(spark, sf_dir), CONFIG.batch_size).groupBy("batch_id").agg(F.count("*").alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def running_watermark(spark, sf_dir):
    return _flow(spark, sf_dir).tracked.select("id", _stamp("eff").alias("watermark"), "pos", "errors_so_far")


def window_snapshot(spark, sf_dir):
    return _flow(spark, sf_dir).snapshots.select("batch_id", _stamp("watermark").alias("watermark"), "total", "errors", F.round("error_rate", 9).alias("error_rate"))


def errors_by_service(spark, sf_dir):
    return _flow(spark, sf_dir).errors_by_service.select("e", "service", "n")


def failed_logins_by_ip(spark, sf_dir):
    return _flow(spark, sf_dir).failed_logins_by_ip.select("e", "ip", "n")


def avg_latency_by_service(spark, sf_dir):
    return _flow(spark, sf_dir).latency_by_service.select("e", "service", F.round("avg_latency_ms", 6).alias("avg_latency_ms"))


def ema_baseline(spark, sf_dir):
    return _flow(spark, sf_dir).baselines.select("e", F.round("baseline", 9).alias("baseline"), F.round("ema", 9).alias("ema"))


def _alerts(alerts):
    return alerts.select("e", _stamp("at").alias("at"), "subject", "severity", F.round("value", 9).alias("value"), "message")


def alert_spike(spark, sf_dir):
    return _alerts(_flow(spark, sf_dir).spike_alerts).drop("message")


def alert_service(spark, sf_dir):
    return _alerts(_flow(spark, sf_dir).service_alerts)


def alert_login(spark, sf_dir):
    return _alerts(_flow(spark, sf_dir).login_alerts)


def alert_docs(spark, sf_dir):
    f = _flow(spark, sf_dir)
    return documents.alert_events(f.service_alerts.unionByName(f.login_alerts)).select("id", "es_id", "target_index", "level", "category", "domain", "severity", "fingerprint", "message", "synthetic")


def all_documents(spark, sf_dir):
    """Event and alert documents of a whole run, one an id."""
    docs = documents.latest(_flow(spark, sf_dir).documents)
    return docs.groupBy("target_index").agg(F.count("*").alias("n"))


def dedupe_replay(spark, sf_dir):
    """The log followed by a replay of all of it."""
    raw = _raw(spark, sf_dir)
    return window.dedupe(parse.events(parse.parse(raw.unionByName(raw)))).groupBy("level").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))


class _Refusing:
    """Answers by the document's number: some are refused, some later accepted."""

    def __init__(self):
        self.seen: set[str] = set()

    def bulk(self, operations):
        out = []
        for op in operations:
            n = int(op.es_id.rpartition("-")[2])
            if n % 50 == 0:
                out.append(delivery.ItemFailure(op, 400, "mapper_parsing_exception"))
            elif n % 50 == 1:
                out.append(delivery.ItemFailure(op, 503, "unavailable"))
            elif n % 50 == 2 and op.es_id not in self.seen:
                self.seen.add(op.es_id)
                out.append(delivery.ItemFailure(op, 429, "too many requests"))
        return out


def retry_triage(spark, sf_dir):
    """Dead letters of a receiver that refuses some documents for good, some always, some once."""
    c = Config(bulk_base_delay_ms=0, bulk_max_delay_ms=0, bulk_max_attempts=3)
    out = delivery.deliver(documents.documents(A.enrich(_analyzed(spark, sf_dir), version="v1")), _Refusing, c)
    return out.where("es_id is not null").select("es_id", "target_index", "http_status", "reason")


def delivered(spark, sf_dir):
    c = Config(bulk_base_delay_ms=0, bulk_max_delay_ms=0, bulk_max_attempts=3)
    out = delivery.deliver(documents.documents(A.enrich(_analyzed(spark, sf_dir), version="v1")), _Refusing, c)
    return out.agg(F.sum("indexed").alias("indexed"), F.count("es_id").alias("dead"))


def sub_batches(spark, sf_dir):
    """Requests of at most 500 documents and 64 KiB, over each index's documents by id."""
    docs = documents.documents(A.enrich(_analyzed(spark, sf_dir), version="v1"))
    return delivery.request_sizes(docs.withColumn("id", F.substr("es_id", F.lit(8)).cast("long")), "id", 500, 1 << 16)


_QUERIES = (
    level_normalize, classify_counts, kv_extract, exception_thread, json_promote, clean_columns, ts_fallback, dead_letters, fingerprint_groups, correlate, route_index, enrich_join, document_json, doc_bytes,
    keyset_page, backlog, checkpoint_advance, batch_numbering, running_watermark, window_snapshot, errors_by_service, failed_logins_by_ip, avg_latency_by_service, ema_baseline, alert_spike, alert_service,
    alert_login, alert_docs, all_documents, dedupe_replay, retry_triage, delivered, sub_batches,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


_PARSED = r"""app_logs as (""" + app_logs.FIXTURE_SQL + r"""),
l0 as (select *, message like '{%}' as is_json, message = '{"a": }' as bad, lower(trim(coalesce(level, ''))) as lv,
    regexp_extract_all(message, '(\w+)=("[^"]*"|\S+)', 1) as ks, regexp_extract_all(message, '(\w+)=("[^"]*"|\S+)', 2) as vs,
    nullif(regexp_extract(message, '\b([A-Za-z_][\w.]*(?:Exception|Error|Throwable))\b', 1), '') as ex,
    nullif(regexp_extract(message, '\[([^\]]+)\]', 1), '') as th from app_logs),
l1 as (select *, case when lv in ('severe', 'error', 'err') then 'ERROR' when lv in ('notice', 'info') then 'INFO' when lv in ('warn', 'warning') then 'WARN' when lv = 'debug' then 'DEBUG' else 'UNKNOWN' end as lvl,
    map_from_entries(list_sort(case when bad then [] when is_json then [
        struct_pack(k := 'level', v := json_extract_string(message, '$.level')), struct_pack(k := 'user', v := json_extract_string(message, '$.user')),
        struct_pack(k := 'context.requestId', v := json_extract_string(message, '$.context.requestId')),
        struct_pack(k := 'context.k', v := cast(cast(json_extract_string(message, '$.context.k') as double) as varchar)), struct_pack(k := 'tags', v := cast(json_extract(message, '$.tags') as varchar))]
      else list_concat(list_transform(range(1, len(ks) + 1), lambda i: struct_pack(k := ks[i], v := trim(vs[i], '"'))),
        case when ex is null then [] else [struct_pack(k := 'exception', v := ex)] end, case when th is null then [] else [struct_pack(k := 'thread', v := th)] end) end)) as fields from l0),
parsed as (select id, ts as tm, case when is_json and lvl = 'UNKNOWN' and not bad then 'WARN' else lvl end as level, service, message,
    coalesce(user_id, try_cast(fields['user'] as bigint)) as user_id, ip, coalesce(status_code, case when not is_json then try_cast(fields['status'] as int) end) as status_code, latency_ms, stack_trace, fields, bad,
    array_to_string(list_sort(list_transform(map_entries(fields), lambda e: e.key || '=' || e.value)), ';') as pairs from l1),
ev as (select *, fields['exception'] as exception,
    case when status_code in (401, 403) then 'AUTH' when status_code = 429 then 'RATE_LIMIT' when status_code >= 500 then 'SERVER_ERROR' when status_code >= 400 then 'CLIENT_ERROR'
      when fields['exception'] is null then 'GENERAL' when lower(fields['exception']) like '%sql%' then 'DATABASE' else 'EXCEPTION' end as category,
    case when service is null then 'UNKNOWN' when service in ('payment-api', 'checkout-svc') then 'PAYMENTS' when service = 'auth-svc' then 'ACCOUNT' else 'CATALOG' end as domain,
    case when level in ('ERROR', 'FATAL') or coalesce(status_code, 0) >= 500 then 'CRITICAL' when level = 'WARN' or coalesce(status_code, 0) >= 400 then 'DEGRADED' else 'NORMAL' end as severity,
    coalesce(fields['traceId'], fields['session']) as trace_id from parsed where not bad)"""

_SCRUB = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\\$\\$Lambda\\$\\d+/0x[0-9a-fA-F]+', '$$Lambda', 'g'), '@[0-9a-fA-F]+', '@', 'g'), '0x[0-9a-fA-F]+', '0x', 'g'), ':\\d+', ':', 'g'), '\\d{{2,}}', '#', 'g'), '\\s+', ' ', 'g'))"
_PRINTS = ", fp as (select *, substr(sha256(case when stack_trace is not null then array_to_string(list_transform(string_split(stack_trace, chr(10)), lambda x: " + _SCRUB.format(x="trim(x, ' ' || chr(9))") + "), chr(10)) else trim(coalesce(exception, '') || '|' || coalesce(service, '') || '|' || " + _SCRUB.format(x="message") + ") end), 1, 16) as fingerprint from ev)"

_DOCS = _PRINTS + r""", docs as (select 'applog-' || id as es_id, 'app-logs-' || strftime(tm, '%Y.%m.%d') as target_index, cast(json_object(
    '@timestamp', regexp_replace(strftime(tm, '%Y-%m-%dT%H:%M:%S.%f'), '(\.000000|000)$', '') || 'Z', 'level', level, 'service', service, 'message', message, 'sourceId', id, 'userId', user_id, 'ip', ip,
    'statusCode', status_code, 'latencyMs', latency_ms, 'stackTrace', stack_trace, 'category', category, 'domain', domain, 'severity', severity, 'fingerprint', fingerprint, 'traceId', trace_id, 'synthetic', false,
    'enrichment', json_object('deploymentVersion', 'v1'), 'fields', to_json(fields)) as varchar) as body from fp)"""

_WINDOW = r""", raw as (select id, (row_number() over (order by id) - 1) // 250 as batch_id from app_logs),
w as (select ev.id, raw.batch_id, coalesce(service, 'UNKNOWN') as service, severity = 'CRITICAL' as is_error, category = 'AUTH' as is_auth, ip, latency_ms,
    max(tm) over (order by ev.id) as eff, row_number() over (order by ev.id) as pos, sum((severity = 'CRITICAL')::int) over (order by ev.id) as errors_so_far from ev join raw using (id)),
evals as (select batch_id, max(id) as last_id, max(eff) as watermark, row_number() over (order by batch_id) as e from w group by batch_id),
live as (select evals.e, evals.batch_id as eb, watermark, w.* from evals join w on w.id <= evals.last_id and w.eff >= evals.watermark - interval 1 day),
snaps as (select e, eb as batch_id, watermark, count(*) as total, sum(is_error::int) as errors, sum(is_error::int) / count(*) as rate from live group by all)"""

_EMA = r""", used as (select *, row_number() over (order by e) as o from snaps where total >= 50),
emas as (select e, o, cast(null as double) as baseline, rate as ema from used where o = 1
  union all select u.e, u.o, m.ema, 0.3 * u.rate + (1 - 0.3) * m.ema from emas m join used u on u.o = m.o + 1)"""

_ALERTS = _EMA + r""", alerts as (
  select s.e, watermark, 'ERROR_RATE_SPIKE' as rule, 'GLOBAL' as subject, 'CRITICAL' as severity, rate as value, '' as message from snaps s join emas using (e) where baseline > 0 and rate > 3.0 * baseline
  union all select e, watermark, 'SERVICE_ERROR_CONCENTRATION', service, 'CRITICAL', count(*), printf('Service ''%s'' produced %d errors in 86400s', service, count(*)) from live where is_error group by e, watermark, service having count(*) >= 25
  union all select e, watermark, 'FAILED_LOGIN_BURST', ip, 'DEGRADED', count(*), printf('%d failed auth attempts from %s in 86400s', count(*), ip) from live where is_auth and ip is not null group by e, watermark, ip having count(*) >= 20)"""

_PACKED = r""", sized as (select target_index, strlen(body) as size, row_number() over (partition by target_index order by substr(es_id, 8)::bigint) as k from docs),
packed as (select target_index, k, 0 as request, 1 as n, size as b from sized where k = 1
  union all select s.target_index, s.k, case when p.n >= 500 or p.b + s.size > 65536 then p.request + 1 else p.request end,
    case when p.n >= 500 or p.b + s.size > 65536 then 1 else p.n + 1 end, case when p.n >= 500 or p.b + s.size > 65536 then s.size else p.b + s.size end
  from packed p join sized s on s.target_index = p.target_index and s.k = p.k + 1)"""

_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S.%f')"


def _sql(body: str, *parts: str) -> str:
    return f"with recursive {_PARSED}{''.join(parts)}\n{body}"


def oracle_sql() -> dict[str, str]:
    alert = lambda rule, more=", message": _sql(f"select e, {_STAMP.format('watermark')} as \"at\", subject, severity, round(value::double, 9) as value{more} from alerts where rule = '{rule}'", _WINDOW, _ALERTS)
    given = "strftime(ts, '%Y-%m-%dT%H:%M:%S')"
    return {
        "level_normalize": _sql("select id, level from parsed"),
        "classify_counts": _sql("select category, domain, severity, count(*) as n from ev group by all"),
        "kv_extract": _sql("select id, pairs from ev where message not like '{%'"),
        "exception_thread": _sql("select id, exception, fields['thread'] as thread from ev where exception is not null or fields['thread'] is not null"),
        "json_promote": _sql("select id, level, user_id, pairs from ev where message like '{%'"),
        "clean_columns": _sql(f"select id, {_STAMP.format('tm')} as \"at\", service, message, user_id, ip, status_code, latency_ms, stack_trace from ev"),
        "ts_fallback": _sql(f"""select id, case id % 6 when 0 then epoch_us(ts) // 1000000 * 1000 when 1 then epoch_us(ts) // 1000 when 2 then epoch_ms(strptime({given}, '%Y-%m-%dT%H:%M:%S') - interval 2 hour) when 3 then epoch_us(ts) // 1000000 * 1000 end as at_ms,
            case id % 6 when 4 then 'IllegalArgumentException: unparseable timestamp: ''yesterday''' when 5 then 'IllegalArgumentException: no usable timestamp (column null and none in message)' end as reason from app_logs"""),
        "dead_letters": _sql("select id as source_id, message as raw_message, 'IllegalArgumentException: malformed JSON ' as reason from parsed where bad"),
        "fingerprint_groups": _sql("select fingerprint, count(*) as n, min(id) as first_id from fp group by 1", _PRINTS),
        "correlate": _sql("select id, trace_id from ev where trace_id is not null"),
        "route_index": _sql("select 'applog-' || id as es_id, 'app-logs-' || strftime(tm, '%Y.%m.%d') as target_index from ev"),
        "enrich_join": _sql("""select id, array_to_string(list_filter(['deploymentVersion=v1', 'geo=' || n_name, 'segment=' || c_mktsegment], lambda x: x is not null), ';') as enrichment
            from ev left join nation on ip = '198.51.100.' || n_nationkey left join customer on user_id = c_custkey"""),
        "document_json": _sql("select es_id, target_index, body from docs", _DOCS),
        "doc_bytes": _sql("select target_index, count(*) as n, sum(strlen(body))::bigint as total_bytes, max(strlen(body))::int as most_bytes from docs group by 1", _DOCS),
        "keyset_page": _sql("select id, service, status_code from app_logs where id > 500 order by id limit 250"),
        "backlog": _sql("select greatest(0, max(id) - 500) as backlog from app_logs"),
        "checkpoint_advance": _sql("select 'app-logs' as pipeline_name, max(id) as last_processed_id from app_logs"),
        "batch_numbering": _sql("select batch_id, count(*) as n, min(id) as first_id, max(id) as last_id from raw group by 1", _WINDOW),
        "running_watermark": _sql(f"select id, {_STAMP.format('eff')} as watermark, pos, errors_so_far::bigint as errors_so_far from w", _WINDOW),
        "window_snapshot": _sql(f"select batch_id, {_STAMP.format('watermark')} as watermark, total, errors::bigint as errors, round(rate, 9) as error_rate from snaps", _WINDOW),
        "errors_by_service": _sql("select e, service, count(*) as n from live where is_error group by 1, 2", _WINDOW),
        "failed_logins_by_ip": _sql("select e, ip, count(*) as n from live where is_auth and ip is not null group by 1, 2", _WINDOW),
        "avg_latency_by_service": _sql("select e, service, round(sum(latency_ms)::double / count(*), 6) as avg_latency_ms from live where latency_ms is not null group by 1, 2", _WINDOW),
        "ema_baseline": _sql("select s.e, round(baseline, 9) as baseline, round(ema, 9) as ema from snaps s left join emas using (e)", _WINDOW, _EMA),
        "alert_spike": alert("ERROR_RATE_SPIKE", ""),
        "alert_service": alert("SERVICE_ERROR_CONCENTRATION"),
        "alert_login": alert("FAILED_LOGIN_BURST"),
        "alert_docs": _sql("""select -1::bigint as id, 'alert-' || rule || '-' || subject || '-' || floor(epoch(watermark))::bigint as es_id, 'app-alerts-' || strftime(watermark, '%Y.%m.%d') as target_index,
            case severity when 'CRITICAL' then 'ERROR' else 'WARN' end as level, 'ALERT' as category, 'OBSERVABILITY' as domain, severity, 'alert:' || rule as fingerprint, message, true as synthetic from alerts where rule <> 'ERROR_RATE_SPIKE'""", _WINDOW, _ALERTS),
        "all_documents": _sql("""select target_index, count(distinct es_id) as n from (select 'applog-' || id as es_id, 'app-logs-' || strftime(tm, '%Y.%m.%d') as target_index from ev
            union all select 'alert-' || rule || '-' || subject || '-' || floor(epoch(watermark))::bigint, 'app-alerts-' || strftime(watermark, '%Y.%m.%d') from alerts) group by 1""", _WINDOW, _ALERTS),
        "dedupe_replay": _sql("select level, count(*) as n, sum(id)::bigint as ids from ev group by 1"),
        "retry_triage": _sql("select 'applog-' || id as es_id, 'app-logs-' || strftime(tm, '%Y.%m.%d') as target_index, case when id % 50 = 0 then 400 else 0 end as http_status, case when id % 50 = 0 then 'mapper_parsing_exception' else 'retries exhausted' end as reason from ev where id % 50 < 2"),
        "sub_batches": _sql("""select target_index, request::int as request, max(n)::int as n_docs, max(b)::bigint as n_bytes from packed group by 1, 2""", _DOCS, _PACKED),
        "delivered": _sql("select count(*) filter (where id % 50 >= 2) as indexed, count(*) filter (where id % 50 < 2) as dead from ev"),
    }
