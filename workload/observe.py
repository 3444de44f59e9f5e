"""Forecasts, freshness, run metrics, scores, breaker states, streams, sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir import functions as X
from lakeweir.operators import breaker, forecast, health
from lakeweir.plans import marts, staging
from lakeweir.session import working_path
from lakeweir.sources import documents, sinks
from lakeweir.sources.catalog import Catalog, Dataset
from lakeweir.streaming import (
    breaker_stream,
    dedup_stream,
    latest_states,
    run_available,
    stream_files,
    upsert_stream,
)
from workload.models import FCT_ALERTS, STG_ALERTS
from workload.registry import query
from workload.tables import ALERTS, BOOKS, METRICS, Tables

PRICES = """
daily AS (
  SELECT c_nationkey AS series, CAST(o_orderdate AS DATE) AS extraction_date, avg(o_totalprice) AS price
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY series ORDER BY extraction_date) - 1 AS x FROM daily),
fit AS (SELECT series, count(*) AS n, max(extraction_date) AS last_day, regr_slope(price, x) AS m,
        regr_intercept(price, x) AS b FROM ranked GROUP BY series HAVING count(*) >= 3)"""


@query(
    f"""WITH {PRICES}
    SELECT series, extraction_date, round(price, 7) AS price, round(price, 7) AS forecasted_price, false AS is_forecast FROM daily
    UNION ALL SELECT series, CAST(last_day + CAST(k AS INTEGER) AS DATE), NULL,
      round(greatest(m * (n + k - 1) + b, 0.01), 4), true FROM fit, (SELECT unnest(range(1, 8)) AS k) s"""
)
def price_forecast(t: Tables) -> DataFrame:
    prices = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_nationkey").alias("series"), F.col("o_orderdate").alias("extraction_date"), F.col("o_totalprice").alias("price")
    )
    # A day's mean is exact to more digits than a fitted line.
    value = F.col("forecasted_price")
    return forecast.forecast_prices(prices, ["series"]).withColumns(
        {
            "price": F.round("price", 7),
            "forecasted_price": F.when(F.col("is_forecast"), F.round(value, 4)).otherwise(F.round(value, 7)),
        }
    )


# Freshness: event types are sources with intervals of their own; one source is not defined, one
# defined source has no table.

DEFINITIONS = [
    ("click", "clicks", 600, "no clicks"),
    ("error", "errors", 3600, "no errors"),
    ("purchase", "purchases", 1200, "no purchases"),
    ("signup", "signups", 86400, "no signups"),
    ("survey", "surveys", 60, "no surveys"),
]
AS_OF = "2024-01-31 00:40:00"

FRESHNESS = f"""
definitions(source, tab, interval_seconds, gap) AS (VALUES {', '.join(str(d) for d in DEFINITIONS)}),
seen AS (SELECT event_type AS source, max(ts) AS last_extraction FROM events GROUP BY 1),
ages AS (SELECT coalesce(d.source, s.source) AS source, d.source IS NOT NULL AS known, interval_seconds, gap,
         epoch(TIMESTAMP '{AS_OF}' - last_extraction) AS age
         FROM definitions d FULL OUTER JOIN seen s ON d.source = s.source),
states AS (SELECT *, CASE WHEN NOT known OR age IS NULL THEN 'unavailable' WHEN age <= interval_seconds THEN 'live'
         WHEN age <= interval_seconds * 2 THEN 'delayed' WHEN age <= interval_seconds * 4 THEN 'stale' ELSE 'critical' END AS state
         FROM ages),
freshness AS (SELECT source, state, CASE WHEN known THEN CAST(round_even(age, 0) AS BIGINT) END AS age_seconds,
         CASE WHEN known AND age IS NOT NULL THEN CAST(interval_seconds AS BIGINT) END AS interval_seconds,
         CASE WHEN NOT known THEN 'Source ''' || source || ''' not configured' WHEN state <> 'live' THEN gap END AS gap_description
         FROM states)"""


def _freshness(t: Tables) -> DataFrame:
    seen = t.events.groupBy(F.col("event_type").alias("source")).agg(F.max("ts").alias("last_extraction"))
    return health.assess_freshness(
        seen, health.source_definitions(t.spark, DEFINITIONS), F.lit(AS_OF).cast("timestamp_ntz")
    )


@query(f"WITH {FRESHNESS} SELECT * FROM freshness")
def freshness_states(t: Tables) -> DataFrame:
    return _freshness(t)


@query(
    """SELECT 'events' AS source, max(ts) AS last_extraction, count(*) AS row_count FROM events
    UNION ALL SELECT 'orders', max(o_orderdate), count(*) FROM orders
    UNION ALL SELECT 'lineitem', max(l_shipdate), count(*) FROM lineitem"""
)
def last_extractions(t: Tables) -> DataFrame:
    return health.last_extractions(
        {
            "events": t.events.select(F.col("ts").alias("extracted_at")),
            "orders": t.orders.select(F.col("o_orderdate").alias("extracted_at")),
            "lineitem": t.lineitem.select(F.col("l_shipdate").alias("extracted_at")),
        }
    )


@query(f"WITH {METRICS} SELECT * FROM run_metrics")
def run_metrics(t: Tables) -> DataFrame:
    return t.run_metrics


@query(f"WITH {METRICS} SELECT * FROM run_metrics QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_date DESC, dag_id DESC) = 1")
def latest_per_source(t: Tables) -> DataFrame:
    return health.latest_metrics(t.run_metrics)


# Breaker calls: two of three events fail.

BREAKER = """
calls AS (SELECT event_type AS source, epoch_us(ts) AS us, event_id, event_id % 3 = 0 AS ok FROM events),
runs AS (SELECT source, list({'us': us, 'ok': ok} ORDER BY us, event_id) AS calls FROM calls GROUP BY source),
folded AS (SELECT source, list_reduce(list_transform(calls,
    lambda c: {'open': false, 'n': 0::BIGINT, 'since': c.us, 'trips': 0::BIGINT, 'us': c.us, 'ok': c.ok}),
    lambda s, c: CASE
      WHEN s.open AND c.us < s.since + 300000000 THEN {'open': s.open, 'n': s.n, 'since': s.since, 'trips': s.trips, 'us': c.us, 'ok': c.ok}
      WHEN c.ok THEN {'open': false, 'n': 0::BIGINT, 'since': s.since, 'trips': s.trips, 'us': c.us, 'ok': c.ok}
      ELSE {'open': s.n + 1 >= 2, 'n': s.n + 1, 'since': c.us, 'trips': s.trips + CASE WHEN s.n + 1 >= 2 THEN 1 ELSE 0 END, 'us': c.us, 'ok': c.ok}
    END, {'open': false, 'n': 0::BIGINT, 'since': 0::BIGINT, 'trips': 0::BIGINT, 'us': 0::BIGINT, 'ok': true}) AS s FROM runs)"""
_STATE = f"CASE WHEN NOT s.open THEN 'closed' WHEN epoch_us(TIMESTAMP '{AS_OF}') - s.since >= 300000000 THEN 'half_open' ELSE 'open' END"


def _calls(t: Tables) -> DataFrame:
    return t.events.select(F.col("event_type").alias("source"), "ts", (F.col("event_id") % 3 == 0).alias("ok"), "event_id")


@query(
    f"""WITH {BREAKER} SELECT source, {_STATE} AS state, s.n AS failure_count, s.trips AS trips,
    make_timestamp(s.since) AS last_failure_at FROM folded"""
)
def breaker_states(t: Tables) -> DataFrame:
    return breaker.breaker_states(_calls(t), F.lit(AS_OF).cast("timestamp_ntz"), order=["event_id"])


HEALTH = f"""{FRESHNESS}, {METRICS},
last AS (SELECT * FROM run_metrics QUALIFY row_number() OVER (PARTITION BY source ORDER BY run_date DESC) = 1),
breakers AS (SELECT event_type AS source, CASE WHEN max(event_id) % 2 = 0 THEN 'open' ELSE 'closed' END AS state
             FROM events GROUP BY 1),
inputs AS (SELECT source,
   greatest(0.0::DOUBLE, 1.0::DOUBLE - coalesce(age_seconds, 0) / (coalesce(interval_seconds, 1) * 4)) * CASE WHEN b.state = 'open' THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS freshness_ratio,
   CASE WHEN coalesce(items_extracted, 0) <> 0 THEN least(1.0::DOUBLE, items_extracted / 10.0::DOUBLE) ELSE 0.5::DOUBLE END AS volume_ratio,
   CASE WHEN coalesce(items_extracted, 0) <> 0 THEN errors / (items_extracted + errors) ELSE coalesce(errors, 0)::DOUBLE END AS error_rate,
   1.0::DOUBLE AS schema_compliance
   FROM freshness LEFT JOIN last USING (source) LEFT JOIN breakers b USING (source))"""


def _inputs(t: Tables) -> DataFrame:
    states = t.events.groupBy(F.col("event_type").alias("source")).agg(
        F.when(F.max("event_id") % 2 == 0, "open").otherwise("closed").alias("state")
    )
    return health.health_inputs(_freshness(t), health.latest_metrics(t.run_metrics), states)


_RATIOS = ("freshness_ratio", "volume_ratio", "error_rate", "schema_compliance")


@query(f"WITH {HEALTH} SELECT source, {', '.join(f'round({c}, 9) AS {c}' for c in _RATIOS)} FROM inputs")
def health_inputs(t: Tables) -> DataFrame:
    return _inputs(t).withColumns({c: F.round(c, 9) for c in _RATIOS})


_CLAMPED = {
    "freshness_score": "least(1, greatest(0, freshness_ratio)) * 100",
    "volume_score": "least(1, greatest(0, volume_ratio)) * 100",
    "error_score": "least(1, greatest(0, 1 - error_rate)) * 100",
    "schema_score": "least(1, greatest(0, schema_compliance)) * 100",
}


@query(
    f"""WITH {HEALTH}, parts AS (SELECT source, {', '.join(f'{v} AS {k}' for k, v in _CLAMPED.items())} FROM inputs),
    scored AS (SELECT source, {', '.join(f'round({k}, 1) AS {k}' for k in _CLAMPED)},
       round(freshness_score * 0.30::DOUBLE + volume_score * 0.25::DOUBLE + error_score * 0.25::DOUBLE + schema_score * 0.20::DOUBLE, 1) AS score FROM parts)
    SELECT *, CASE WHEN score >= 90 THEN 'A' WHEN score >= 80 THEN 'B' WHEN score >= 70 THEN 'C' WHEN score >= 50 THEN 'D' ELSE 'F' END AS grade
    FROM scored"""
)
def quality_scores(t: Tables) -> DataFrame:
    return health.quality_scores(_inputs(t))


# Streams: the events file read as a stream of landing files until nothing is left.


@query(f"WITH {FCT_ALERTS} SELECT * FROM fct_alerts")
def stream_upsert(t: Tables) -> DataFrame:
    target, checkpoint = working_path(t.spark, "stream-table"), working_path(t.spark, "stream-state")
    stream = stream_files(t.spark, t.folder, t.events.schema, pattern="events.parquet")

    def prepare(batch: DataFrame) -> DataFrame:
        landed = Tables(t.spark, t.folder)
        landed.__dict__["events"] = batch
        return marts.fct_alerts(staging.stg_alerts(landed.alerts))

    query_ = upsert_stream(
        stream, target, checkpoint, ["alert_key", "extraction_date"], partition_by="extraction_date", prepare=prepare
    )
    query_.awaitTermination()
    schema = marts.fct_alerts(staging.stg_alerts(t.alerts)).schema
    return t.spark.read.schema(schema).parquet(target)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    stream = stream_files(t.spark, t.folder, t.events.schema, pattern="events.parquet")
    timed = stream.withColumn("seen_at", F.col("ts").cast("timestamp"))
    unique = dedup_stream(timed, ["user_id", "event_type"], "seen_at", "400 days")
    path = working_path(t.spark, "stream-dedup")
    run_available(unique.select("user_id", "event_type"), path, working_path(t.spark, "stream-state"))
    return t.spark.read.schema("user_id bigint, event_type string").parquet(path)


@query(
    f"""WITH {BREAKER} SELECT source, CASE WHEN NOT s.open THEN 'closed'
      WHEN (SELECT max(epoch_us(ts)) FROM events) - s.since >= 300000000 THEN 'half_open' ELSE 'open' END AS state,
    s.n AS failure_count, s.trips AS trips, make_timestamp(s.since) AS last_failure_at FROM folded"""
)
def stream_breaker(t: Tables) -> DataFrame:
    landed = Tables(t.spark, t.folder)
    landed.__dict__["events"] = stream_files(t.spark, t.folder, t.events.schema, pattern="events.parquet")
    path = working_path(t.spark, "stream-breaker")
    breaker_stream(_calls(landed), path, working_path(t.spark, "stream-state"), order=["event_id"]).awaitTermination()
    return latest_states(t.spark.read.parquet(path))


# Sources and sinks: written with the sink, read back with the source.


@query(f"WITH {STG_ALERTS} SELECT * FROM stg_alerts WHERE extraction_date = DATE '2024-01-05'")
def partitioned_scan(t: Tables) -> DataFrame:
    path = working_path(t.spark, "partitioned")
    staged = staging.stg_alerts(t.alerts)
    sinks.replace_partitions(staged, path, "extraction_date")
    day = staged.schema["extraction_date"]
    catalog = Catalog(t.spark, {"stg_alerts": Dataset(path, "partitioned", staged.drop("extraction_date").schema, day)})
    return catalog["stg_alerts"].where("extraction_date = DATE '2024-01-05'")


@query(
    f"""WITH {STG_ALERTS}
    SELECT extraction_date, color_hex, count(*) AS n FROM (
      SELECT extraction_date, CASE WHEN extraction_date >= DATE '2024-01-10' THEN '#000000' ELSE color_hex END AS color_hex
      FROM stg_alerts) GROUP BY ALL"""
)
def partition_overwrite(t: Tables) -> DataFrame:
    path = working_path(t.spark, "overwrite")
    staged = staging.stg_alerts(t.alerts)
    sinks.replace_partitions(staged, path, "extraction_date")
    changed = staged.where("extraction_date >= DATE '2024-01-10'").withColumn("color_hex", F.lit("#000000"))
    sinks.replace_partitions(changed, path, "extraction_date")
    return t.spark.read.schema(staged.schema).parquet(path).groupBy("extraction_date", "color_hex").agg(F.count("*").alias("n"))


@query(f"WITH {BOOKS} SELECT category, count(*) AS books, CAST(sum(stock_count) AS BIGINT) AS stock FROM books WHERE price < 30 GROUP BY category")
def snapshot_overwrite(t: Tables) -> DataFrame:
    path = working_path(t.spark, "snapshot")
    sinks.replace_snapshot(t.books, path)
    catalog = Catalog(t.spark, {"books": Dataset(path, "snapshot", t.books.schema)})
    sinks.replace_snapshot(catalog["books"].where("price < 30"), path)
    return catalog["books"].groupBy("category").agg(F.count("*").alias("books"), F.sum("stock_count").alias("stock"))


@query(
    f"""WITH {ALERTS}, f AS (SELECT * REPLACE (CASE WHEN extraction_date > DATE '2024-01-20' THEN '#000000' ELSE color_hex END AS color_hex)
      FROM alerts) SELECT extraction_date, color_hex, count(*) AS n FROM f WHERE department_code IS NOT NULL GROUP BY ALL"""
)
def upsert_table_partitions(t: Tables) -> DataFrame:
    path, keys = working_path(t.spark, "upsert-table"), ["alert_key", "extraction_date"]
    facts = marts.fct_alerts(staging.stg_alerts(t.alerts))
    sinks.upsert_table(facts, path, facts.schema, keys, partition_by="extraction_date")
    late = facts.where("extraction_date > DATE '2024-01-20'").withColumn("color_hex", F.lit("#000000"))
    sinks.upsert_table(late, path, facts.schema, keys, partition_by="extraction_date")
    return t.spark.read.schema(facts.schema).parquet(path).groupBy("extraction_date", "color_hex").agg(F.count("*").alias("n"))


@query(
    """SELECT strftime(coalesce(TRY_CAST(substr(d, 1, 10) AS DATE), DATE '2024-02-02'), '%Y') AS year,
    strftime(coalesce(TRY_CAST(substr(d, 1, 10) AS DATE), DATE '2024-02-02'), '%m') AS month, count(*) AS n,
    CAST(sum(event_id) AS BIGINT) AS ids FROM (
      SELECT event_id, CASE WHEN event_type = 'error' THEN 'not a date' ELSE strftime(ts, '%Y-%m-%dT%H:%M') END AS d FROM events)
    GROUP BY 1, 2"""
)
def document_files(t: Tables) -> DataFrame:
    path = working_path(t.spark, "documents")
    text = F.when(F.col("event_type") == "error", "not a date").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm"))
    rows = t.events.select("event_id", "event_type", text.alias("date_text"))
    sinks.write_documents(rows, path, "retail", "events", "date_text", "2024-02-02")
    schema = "event_id bigint, event_type string, domain string, source string, year string, month string, day string"
    back = documents.read_documents(t.spark, path, schema, lines=True)
    return back.where("domain = 'retail' AND source = 'events'").groupBy("year", "month").agg(
        F.count("*").alias("n"), F.sum("event_id").alias("ids")
    )


@query(
    """SELECT event_id, date_trunc('millisecond', ts) AS parsed, CAST(CASE WHEN value >= 100 THEN 0 ELSE floor(value) END AS INTEGER) AS whole,
    printf('%.2f', value) AS two, upper(event_type[1]) || event_type[2:] || '-X' AS titled,
    strftime(ts, '%d') AS day, CASE WHEN value > 0 THEN round(1.0::DOUBLE / value, 9) ELSE 0.0 END AS inverse,
    CAST(regexp_extract(props, '[0-9.]+') AS DOUBLE) AS number, greatest(0.0::DOUBLE, least(1.0::DOUBLE, value / 50)) AS clamped FROM events"""
)
def scalar_functions(t: Tables) -> DataFrame:
    value, ts = F.col("value"), F.col("ts")
    millis = F.unix_millis(ts.cast("timestamp")).cast("string")
    digits = F.when(value >= 100, "1e3").otherwise(F.floor(value).cast("string"))
    return t.events.select(
        "event_id",
        X.epoch_millis(millis).alias("parsed"),
        X.digits_or_zero(digits).alias("whole"),
        X.fixed_text(value).alias("two"),
        X.title_case(F.concat("event_type", F.lit("-x"))).alias("titled"),
        X.date_parts(ts.cast("string"), F.lit("2024-01-01").cast("date"))["day"].alias("day"),
        F.round(X.guarded_ratio(F.lit(1), value), 9).alias("inverse"),
        X.first_number(F.col("props")).alias("number"),
        X.clamp(value / 50).alias("clamped"),
    )


@query(
    f"""WITH {METRICS} SELECT source, run_date, items_extracted FROM run_metrics
    ORDER BY run_date DESC, source LIMIT 40"""
)
def run_log_tail(t: Tables) -> DataFrame:
    path = working_path(t.spark, "run-log")
    sinks.append_log(t.run_metrics.select("source", "run_date", "items_extracted"), path, "logged_at", AS_OF)
    log = t.spark.read.parquet(path).select("run_date", "source", "items_extracted")
    return sinks.latest_entries(log, "run_date", 40)
