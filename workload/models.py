"""Staging views, marts and reports."""

from __future__ import annotations

from functools import reduce


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.functions import surrogate_key
from lakeweir.operators.snapshot import latest_snapshot
from lakeweir.plans import incremental, marts, refresh, staging
from lakeweir.session import working_path
from lakeweir.sources import sinks
from workload.registry import query
from workload.tables import ALERTS, AUTHORS, BOOKS, DETAILS, MORE_AUTHORS, PROFILES, QUOTES, Tables

# Postgres initcap: DuckDB has none, so words are cut out and capitalised one by one.
TITLE = r"""array_to_string(list_transform(regexp_extract_all({0}, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+'),
            lambda w: upper(w[1]) || lower(w[2:])), '')"""

STG_ALERTS = f"""{ALERTS},
stg_alerts AS (
  SELECT id AS alert_row_id, trim(department_code) AS department_code, trim(department_name) AS department_name,
         phenomenon_id, trim(phenomenon_name) AS phenomenon_name, begin_time, end_time, color_id,
         trim(color_name) AS color_name, coalesce(color_level, 0) AS color_level, trim(color_hex) AS color_hex,
         extracted_at, extraction_date, created_at
  FROM alerts WHERE department_code IS NOT NULL AND phenomenon_name IS NOT NULL)"""

_COUNTS = ", ".join(f"coalesce({c}, 0) AS {c}" for c in staging.COUNT_COLUMNS)
_FLAGS = ", ".join(f"coalesce({c}, false) AS {c}" for c in staging.FLAG_COLUMNS)
STG_PROFILES = f"""{PROFILES},
stg_profiles AS (
  SELECT id AS profile_row_id, trim(insee_code) AS insee_code, trim(commune) AS commune,
         trim(code_postal) AS code_postal, trim(department_code) AS department_code,
         trim(department_name) AS department_name, trim(region) AS region, {_COUNTS}, {_FLAGS},
         extracted_at, extraction_date, created_at
  FROM commune_profiles WHERE insee_code IS NOT NULL)"""

STG_DETAILS = f"""{DETAILS},
stg_details AS (
  SELECT id AS detail_row_id, trim(insee_code) AS insee_code, trim(risk_category) AS risk_category,
         trim(risk_key) AS risk_key, trim(risk_libelle) AS risk_libelle, coalesce(present, false) AS present,
         trim(statut_commune) AS statut_commune, trim(statut_adresse) AS statut_adresse,
         trim(severity_label) AS severity_label, coalesce(severity_score, 0) AS severity_score,
         extracted_at, extraction_date, created_at
  FROM risk_details WHERE insee_code IS NOT NULL AND risk_key IS NOT NULL)"""

STG_BOOKS = f"""{BOOKS},
stg_books AS (
  SELECT id AS book_id, trim(upc) AS upc, trim(title) AS title, {TITLE.format('trim(category)')} AS category,
         star_rating, price, price_incl_tax, tax, trim(availability) AS availability_text, stock_count,
         CASE WHEN stock_count > 0 THEN true ELSE false END AS is_in_stock, trim(description) AS description,
         image_url, product_url,
         CASE WHEN price < 15 THEN 'Budget' WHEN price < 35 THEN 'Mid-range' WHEN price < 55 THEN 'Premium'
              ELSE 'Luxury' END AS price_tier,
         CASE WHEN star_rating >= 4 THEN 'Excellent' WHEN star_rating >= 3 THEN 'Good'
              WHEN star_rating >= 2 THEN 'Average' ELSE 'Poor' END AS rating_category,
         extracted_at, extraction_date, created_at
  FROM books WHERE upc IS NOT NULL AND length(trim(upc)) >= 2)"""

STG_QUOTES = f"""{QUOTES}, {AUTHORS},
stg_quotes AS (
  SELECT q.id AS quote_id, q.quote_hash, q.author_slug, trim(q.text, ' ') AS quote_text,
         trim(q.author_name) AS author_name, q.tags AS tags_json, a.born_date AS author_born_date,
         a.born_location AS author_born_location, CAST(length(q.text) AS INTEGER) AS quote_length,
         CASE WHEN length(q.text) < 100 THEN 'Short' WHEN length(q.text) < 250 THEN 'Medium' ELSE 'Long' END
           AS quote_length_category,
         q.extracted_at, q.extraction_date, q.created_at
  FROM quotes q LEFT JOIN authors a ON q.author_slug = a.slug WHERE q.quote_hash IS NOT NULL)"""

NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def sql_key(*columns: str) -> str:
    parts = [f"coalesce(CAST({c} AS VARCHAR), '{NULL_TOKEN}')" for c in columns]
    return "md5(" + " || '-' || ".join(parts) + ")"


DIM_BOOKS = f"""{STG_BOOKS},
dim_books AS (
  SELECT {sql_key('upc')} AS book_key, upc, title, category, star_rating, price, price_incl_tax, tax,
         availability_text, stock_count, is_in_stock, price_tier, rating_category, product_url, image_url,
         extracted_at, extraction_date FROM stg_books)"""

DIM_AUTHORS = f"""{STG_QUOTES}, {MORE_AUTHORS},
all_quotes AS (
  SELECT author_slug, author_name, author_born_date, author_born_location FROM stg_quotes
  UNION ALL SELECT * FROM more_authors),
dim_authors AS (
  SELECT {sql_key('author_slug')} AS author_key, * FROM (SELECT DISTINCT * FROM all_quotes) s
  WHERE author_slug IS NOT NULL)"""

FCT_QUOTES = f"""
fct_quotes AS (
  SELECT {sql_key('quote_hash')} AS quote_key, quote_hash, {sql_key('author_slug')} AS author_key, quote_text,
         tags_json, quote_length, quote_length_category, extracted_at, extraction_date FROM stg_quotes)"""

FCT_ALERTS = f"""{STG_ALERTS},
fct_alerts AS (
  SELECT {sql_key('department_code', 'phenomenon_id', 'begin_time', 'extraction_date')} AS alert_key,
         {sql_key('department_code')} AS department_key, department_code, department_name, phenomenon_id,
         phenomenon_name, color_name, color_level, color_hex,
         extract(epoch FROM (end_time - begin_time)) / 3600.0 AS duration_hours,
         begin_time, end_time, extraction_date, extracted_at
  FROM stg_alerts)"""

_COMMUNE_COLUMNS = (
    "commune, code_postal, department_code, department_name, region, naturels_count, technologiques_count, "
    "total_risks, max_severity_naturels, max_severity_technologiques, seisme_present, seisme_severity, "
    "rga_present, rga_severity, radon_present, radon_severity, inondation_present, inondation_severity, "
    "icpe_present, nucleaire_present"
)
DIM_COMMUNES = f"""{STG_PROFILES}, {STG_DETAILS},
newest AS (SELECT max(extraction_date) AS d FROM stg_profiles),
listed AS (
  SELECT insee_code, string_agg(CASE WHEN present THEN risk_libelle END, ', ' ORDER BY risk_category, risk_key) AS l
  FROM stg_details WHERE extraction_date = (SELECT d FROM newest) GROUP BY insee_code),
history AS (
  SELECT insee_code, min(extraction_date) AS first_extraction, max(extraction_date) AS last_extraction,
         count(DISTINCT extraction_date) AS extraction_count FROM stg_profiles GROUP BY insee_code),
dim_communes AS (
  SELECT {sql_key('p.insee_code')} AS commune_id, p.insee_code, {_COMMUNE_COLUMNS}, l AS active_risks_list,
         greatest(max_severity_naturels, max_severity_technologiques) AS overall_max_severity,
         first_extraction, last_extraction, extraction_count
  FROM stg_profiles p LEFT JOIN listed USING (insee_code) LEFT JOIN history USING (insee_code)
  WHERE p.extraction_date = (SELECT d FROM newest))"""


@query(f"WITH {STG_ALERTS} SELECT * FROM stg_alerts")
def stg_alerts(t: Tables) -> DataFrame:
    return staging.stg_alerts(t.alerts)


@query(f"WITH {STG_PROFILES} SELECT * FROM stg_profiles")
def stg_profiles(t: Tables) -> DataFrame:
    return staging.stg_commune_profiles(t.commune_profiles)


@query(f"WITH {STG_DETAILS} SELECT * FROM stg_details")
def stg_risk_details(t: Tables) -> DataFrame:
    return staging.stg_risk_details(t.risk_details)


@query(f"WITH {STG_BOOKS} SELECT * FROM stg_books")
def stg_books(t: Tables) -> DataFrame:
    return staging.stg_books(t.books)


@query(f"WITH {STG_QUOTES} SELECT * FROM stg_quotes")
def stg_quotes(t: Tables) -> DataFrame:
    return staging.stg_quotes(t.quotes, t.authors)


@query(f"WITH {DIM_BOOKS} SELECT * FROM dim_books")
def dim_books(t: Tables) -> DataFrame:
    return marts.dim_books(staging.stg_books(t.books))


def _authors(t: Tables) -> DataFrame:
    """Quotes and authors without quotes, so that the report's outer join has a left-only side."""
    columns = ["author_slug", "author_name", "author_born_date", "author_born_location"]
    return marts.dim_authors(staging.stg_quotes(t.quotes, t.authors).select(*columns).unionByName(t.more_authors))


@query(f"WITH {DIM_AUTHORS} SELECT * FROM dim_authors")
def dim_authors(t: Tables) -> DataFrame:
    return _authors(t)


@query(f"WITH {STG_QUOTES}, {FCT_QUOTES} SELECT * FROM fct_quotes")
def fct_quotes(t: Tables) -> DataFrame:
    return marts.fct_quotes(staging.stg_quotes(t.quotes, t.authors))


@query(
    f"""WITH {DIM_BOOKS}
    SELECT category, count(*) AS book_count,
           CAST(round(CAST(avg(price) AS DECIMAL(18,3)), 2) AS DOUBLE) AS avg_price,
           CAST(round(CAST(avg(star_rating) AS DECIMAL(18,3)), 1) AS DOUBLE) AS avg_rating,
           min(price) AS min_price, max(price) AS max_price, CAST(sum(stock_count) AS BIGINT) AS total_stock,
           count(*) FILTER (WHERE star_rating >= 4) AS highly_rated_count
    FROM dim_books GROUP BY category"""
)
def book_stats(t: Tables) -> DataFrame:
    report = marts.rpt_book_stats(marts.dim_books(staging.stg_books(t.books)))
    return report.withColumns({c: F.col(c).cast("double") for c in ("avg_price", "avg_rating")})


@query(
    f"""WITH {DIM_AUTHORS}, {FCT_QUOTES}
    SELECT author_name, author_born_date, author_born_location, count(q.quote_key) AS quote_count,
           CAST(round(CAST(avg(quote_length) AS DECIMAL(18,3)), 1) AS DOUBLE) AS avg_quote_length,
           min(quote_length) AS min_quote_length, max(quote_length) AS max_quote_length
    FROM dim_authors a LEFT JOIN fct_quotes q ON a.author_key = q.author_key
    GROUP BY author_name, author_born_date, author_born_location"""
)
def quote_stats(t: Tables) -> DataFrame:
    quotes = marts.fct_quotes(staging.stg_quotes(t.quotes, t.authors))
    report = marts.rpt_quote_stats(_authors(t), quotes)
    return report.withColumn("avg_quote_length", F.col("avg_quote_length").cast("double"))


@query(f"WITH {DIM_COMMUNES} SELECT * FROM dim_communes")
def dim_communes(t: Tables) -> DataFrame:
    return marts.dim_communes(staging.stg_commune_profiles(t.commune_profiles), staging.stg_risk_details(t.risk_details))


@query(f"WITH {FCT_ALERTS} SELECT * FROM fct_alerts")
def fct_alerts_full(t: Tables) -> DataFrame:
    return marts.fct_alerts(staging.stg_alerts(t.alerts))


_RISK_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE {r}_present) AS {r}" for r in ("seisme", "inondation", "radon", "icpe", "nucleaire")
)


@query(
    f"""WITH {FCT_ALERTS}, {DIM_COMMUNES},
    das AS (
      SELECT department_code, department_name, count(*) AS n, max(color_level) AS level,
             string_agg(DISTINCT phenomenon_name || ' (' || color_name || ')', ', '
                        ORDER BY phenomenon_name || ' (' || color_name || ')') AS labels,
             count(*) FILTER (WHERE color_level >= 3) AS high
      FROM fct_alerts WHERE extraction_date = (SELECT max(extraction_date) FROM fct_alerts)
      GROUP BY department_code, department_name),
    drs AS (
      SELECT department_code, count(*) AS n, round(CAST(avg(total_risks) AS DECIMAL(18,3)), 1) AS avg_risks,
             max(total_risks) AS max_risks, round(CAST(avg(max_severity_naturels) AS DECIMAL(18,3)), 1) AS avg_nat,
             round(CAST(avg(max_severity_technologiques) AS DECIMAL(18,3)), 1) AS avg_tech, {_RISK_COUNTS}
      FROM dim_communes GROUP BY department_code)
    SELECT coalesce(drs.department_code, das.department_code) AS department_code,
           coalesce(das.department_name, c.department_name) AS department_name, c.region,
           coalesce(drs.n, 0) AS monitored_communes,
           CAST(coalesce(avg_risks, 0) AS DOUBLE) AS avg_risks_per_commune,
           coalesce(max_risks, 0) AS max_risks_in_dept, CAST(avg_nat AS DOUBLE) AS avg_severity_naturels,
           CAST(avg_tech AS DOUBLE) AS avg_severity_technologiques,
           coalesce(seisme, 0) AS communes_with_seisme, coalesce(inondation, 0) AS communes_with_inondation,
           coalesce(radon, 0) AS communes_with_radon, coalesce(icpe, 0) AS communes_with_icpe,
           coalesce(nucleaire, 0) AS communes_with_nucleaire, coalesce(das.n, 0) AS active_alert_count,
           coalesce(level, 0) AS max_alert_level, labels AS active_alerts_list, coalesce(high, 0) AS orange_red_count
    FROM drs FULL OUTER JOIN das ON drs.department_code = das.department_code
    LEFT JOIN (SELECT DISTINCT department_code, department_name, region FROM dim_communes) c
      ON coalesce(drs.department_code, das.department_code) = c.department_code
    ORDER BY coalesce(level, 0) DESC, coalesce(max_risks, 0) DESC, 1"""
)
def risk_summary(t: Tables) -> DataFrame:
    communes = marts.dim_communes(
        staging.stg_commune_profiles(t.commune_profiles), staging.stg_risk_details(t.risk_details)
    )
    report = marts.rpt_risk_summary(marts.fct_alerts(staging.stg_alerts(t.alerts)), communes)
    averages = ("avg_risks_per_commune", "avg_severity_naturels", "avg_severity_technologiques")
    return report.withColumns({c: F.col(c).cast("double") for c in averages})


@query(
    f"""WITH {STG_PROFILES}, {STG_DETAILS}
    SELECT insee_code,
           count(*) FILTER (WHERE present AND risk_category = 'naturel') AS active_natural_risks,
           count(*) FILTER (WHERE present AND risk_category = 'technologique') AS active_techno_risks
    FROM stg_details WHERE extraction_date = (SELECT max(extraction_date) FROM stg_profiles) GROUP BY insee_code"""
)
def active_risk_counts(t: Tables) -> DataFrame:
    newest = staging.stg_commune_profiles(t.commune_profiles).agg(F.max("extraction_date").alias("d")).scalar()
    return marts.active_risk_counts(staging.stg_risk_details(t.risk_details), newest)


@query(
    f"""WITH {STG_PROFILES}
    SELECT insee_code, min(extraction_date) AS first_extraction, max(extraction_date) AS last_extraction,
           count(DISTINCT extraction_date) AS extraction_count FROM stg_profiles GROUP BY insee_code"""
)
def extraction_history(t: Tables) -> DataFrame:
    return marts.extraction_history(staging.stg_commune_profiles(t.commune_profiles))


@query(f"WITH {STG_ALERTS} SELECT * FROM stg_alerts WHERE extraction_date = (SELECT max(extraction_date) FROM stg_alerts)")
def latest_alerts(t: Tables) -> DataFrame:
    return latest_snapshot(staging.stg_alerts(t.alerts), "extraction_date")


# Incremental loads: the table holds everything up to a day; the source has all days, with colours
# of some days changed, as a re-extraction would.


def _batches(t: Tables) -> tuple[DataFrame, DataFrame]:
    """(facts up to a day, staged alerts of all days with one column re-extracted differently)."""
    staged = staging.stg_alerts(t.alerts)
    held = marts.fct_alerts(staged.where("extraction_date <= DATE '2024-01-20'"))
    return held, staged.withColumn("color_hex", F.lit("#000000"))


def _merged_sql(since: str) -> str:
    return f"""WITH {FCT_ALERTS}
    SELECT * REPLACE (CASE WHEN extraction_date > DATE '{since}' THEN '#000000' ELSE color_hex END AS color_hex)
    FROM fct_alerts"""


@query(_merged_sql("2024-01-20"))
def fct_alerts_incremental(t: Tables) -> DataFrame:
    return incremental.merge_new_alerts(*_batches(t))


@query(_merged_sql("2024-01-18"))
def fct_alerts_lookback(t: Tables) -> DataFrame:
    return incremental.merge_new_alerts(*_batches(t), lookback_days=2)


@query(
    f"""SELECT o_orderkey, {sql_key('o_orderkey')} AS one, {sql_key('o_orderkey', 'o_orderpriority', 'o_orderdate')} AS three,
    {sql_key("nullif(o_orderstatus, 'F')", 'o_custkey')} AS with_null FROM orders"""
)
def surrogate_keys(t: Tables) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("F"))
    return t.orders.select(
        "o_orderkey",
        surrogate_key(F.col("o_orderkey")).alias("one"),
        surrogate_key(F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderdate")).alias("three"),
        surrogate_key(status, F.col("o_custkey")).alias("with_null"),
    )


@query(
    f"""WITH {FCT_ALERTS}, {DIM_COMMUNES}, {DIM_BOOKS}, {STG_QUOTES},
    departments AS (
      SELECT department_code FROM dim_communes
      UNION SELECT department_code FROM fct_alerts WHERE extraction_date = (SELECT max(extraction_date) FROM fct_alerts))
    SELECT 'rpt_risk_summary' AS report, count(*) AS row_count FROM departments
    UNION ALL SELECT 'rpt_book_stats', count(DISTINCT category) FROM dim_books
    UNION ALL SELECT 'rpt_quote_stats', count(*) FROM
      (SELECT DISTINCT author_name, author_born_date, author_born_location FROM stg_quotes WHERE author_slug IS NOT NULL)"""
)
def refreshed_reports(t: Tables) -> DataFrame:
    """The whole modelling run, from landing tables to gated reports on files."""
    names = ("alerts", "commune_profiles", "risk_details", "books", "quotes", "authors")
    base = working_path(t.spark, "refresh")
    few = sinks.few_values(t.events.select(F.to_date("ts"))) and sinks.few_values(t.orders.select(F.year("o_orderdate")))
    counts = refresh.refresh(t.spark, {n: getattr(t, n) for n in names}, base, "2024-02-01 00:00:00", by_date=few)
    reports = [
        t.spark.read.parquet(f"{base}/marts/{name}").agg(F.count("*").alias("row_count")).select(F.lit(name).alias("report"), "row_count")
        for name in counts
    ]
    return reduce(DataFrame.unionByName, reports)
