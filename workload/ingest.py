"""Normalisation, dictionary joins, upserts, key picks and page parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir import functions as X
from lakeweir.operators import enrich, normalize, pages, snapshot
from lakeweir.operators.upsert import upsert
from workload.registry import query
from workload.tables import ALERTS, PROFILES, QUOTES, Tables, spread

# Dictionaries, derived from the given tables. Some ids have no entry.


def _phenomenon_id(name):
    """click 1, error 2, purchase 3, signup 4, view 5."""
    return F.array_position(F.array(*[F.lit(n) for n in ("click", "error", "purchase", "signup", "view")]), name)


def _phenomena(t: Tables) -> DataFrame:
    names = t.events.select(F.col("event_type").alias("name")).distinct().where("name <> 'view'")
    return names.select(_phenomenon_id(F.col("name")).cast("string").alias("id"), "name")


def _colors(t: Tables) -> DataFrame:
    return t.region.where("r_regionkey BETWEEN 1 AND 3").select(
        F.col("r_regionkey").cast("string").alias("id"),
        F.lower("r_name").alias("name"),
        (F.col("r_regionkey") + 1).cast("int").alias("level"),
        F.concat(F.lit("#0000"), F.lpad(F.col("r_regionkey").cast("string"), 2, "0")).alias("hexaCode"),
    )


def _departments(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("name"), F.col("r_name").alias("region")
    )


_ITEMS = "array<struct<phenomenon_id: string, color_id: bigint, begin_time: bigint, end_time: string>>"


def _alert_documents(t: Tables) -> DataFrame:
    """One JSON document per event: a place with two items and one without any.

    Ids and times come as numbers or text, some of them bad.
    """
    millis = F.unix_millis(F.col("ts").cast("timestamp"))

    def item(n: int):
        return F.struct(
            F.when(F.col("event_id") % 7 == n, F.lit("x"))
            .otherwise(_phenomenon_id(F.col("event_type")).cast("string"))
            .alias("phenomenon_id"),
            ((F.col("event_id") + n) % 5).alias("color_id"),
            (millis + n).alias("begin_time"),
            F.when(F.col("event_id") % 11 == n, F.lit("")).otherwise((millis + 3600000).cast("string")).alias("end_time"),
        )

    place = (F.col("user_id") % 30).cast("string")
    items = F.array(item(0), item(1))
    entries = F.array(
        F.struct(place.alias("domain_id"), items.alias("timelaps_items")),
        F.struct(F.lit("99").alias("domain_id"), F.lit(None).cast(_ITEMS).alias("timelaps_items")),
    )
    return spread(t.events).select(
        F.to_json(F.struct(entries.alias("timelaps"))).alias("document"), F.to_date("ts").alias("extraction_date")
    )


@query(
    """WITH items AS (SELECT *, date_trunc('millisecond', ts) + to_milliseconds(n) AS b,
             event_id % 11 <> n AS good, event_id % 7 = n AS odd, (event_id + n) % 5 AS color
      FROM events, (VALUES (0), (1)) v(n))
    SELECT CAST(user_id % 30 AS VARCHAR) AS department_code, coalesce(n_name, 'inconnu') AS department_name,
    CASE WHEN odd THEN 0 ELSE CAST(list_position(['click','error','purchase','signup','view'], event_type) AS INTEGER) END AS phenomenon_id,
    CASE WHEN odd OR event_type = 'view' THEN 'autre' ELSE event_type END AS phenomenon_name,
    CASE WHEN good THEN b END AS begin_time,
    CASE WHEN good THEN date_trunc('millisecond', ts) + INTERVAL 1 HOUR END AS end_time,
    CAST(color AS INTEGER) AS color_id, coalesce(lower(r_name), 'vert') AS color_name,
    coalesce(CAST(r_regionkey + 1 AS INTEGER), 1) AS color_level,
    coalesce('#0000' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0'), '#31a354') AS color_hex,
    CAST(CAST(ts AS DATE) AS TIMESTAMP) AS extracted_at, CAST(ts AS DATE) AS extraction_date
    FROM items LEFT JOIN nation ON CAST(user_id % 30 AS INTEGER) = n_nationkey
    LEFT JOIN region ON color = r_regionkey AND r_regionkey BETWEEN 1 AND 3"""
)
def alert_explode(t: Tables) -> DataFrame:
    stamped = _alert_documents(t).withColumn("extracted_at", F.col("extraction_date").cast("timestamp_ntz"))
    documents = normalize.open_alert_documents(stamped)
    return normalize.alert_rows(documents, _phenomena(t), _colors(t), _departments(t))


RISK_NAMES = "CASE l_linenumber WHEN 1 THEN 'seisme' WHEN 2 THEN 'retraitGonflementArgile' WHEN 3 THEN 'radon' " \
             "WHEN 4 THEN 'inondation' WHEN 5 THEN 'icpe' WHEN 6 THEN 'nucleaire' ELSE 'autre' END"

# Risk reports: one JSON object per order year of a customer, keyed like the landing tables.


def _risk_reports(t: Tables) -> DataFrame:
    """(document, extraction_date): {commune code: report} with sections of one entry per line number.

    Line numbers may repeat within a customer's year, so lines are reduced to one entry first. One
    value per natural section is a plain text, which has to be skipped.
    """
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    names = ["seisme", "retraitGonflementArgile", "radon", "inondation", "icpe", "nucleaire", "autre"]
    key = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("l_linenumber"))
    level = F.max(F.col("l_orderkey") % 5)
    status = F.element_at(
        F.array(*[F.lit(s) for s in ("Risque Important", "MODÉRÉ", "Inexistant", "", "non connu")]),
        (level + 1).cast("int"),
    )
    entry = joined.groupBy(
        "o_custkey", F.year("o_orderdate").alias("year"), "l_linestatus", "l_linenumber", key.alias("key")
    ).agg(
        F.max("l_quantity").alias("quantity"),
        F.bool_or(F.col("l_discount") >= 0.05).alias("present"),
        status.alias("commune"),
        F.when(F.min(F.col("l_orderkey") % 3) == 0, "zone Faible").otherwise("").alias("address"),
    )
    body = F.struct(
        F.when(~(F.col("quantity") > 45), F.col("present")).alias("present"),
        F.when(F.col("quantity") > 5, F.concat(F.lit("Risk "), "key")).alias("libelle"),
        F.col("commune").alias("libelleStatutCommune"),
        F.col("address").alias("libelleStatutAdresse"),
    )
    pair = F.struct("key", F.to_json(body).alias("body"))
    natural = F.collect_list(F.when(F.col("l_linestatus") == "O", pair))
    technical = F.collect_list(F.when(F.col("l_linestatus") == "F", pair))

    def section(pairs, extra):
        inner = F.transform(pairs, lambda p: F.concat(F.lit('"'), p["key"], F.lit('":'), p["body"]))
        return F.concat(F.lit("{"), F.array_join(F.concat(inner, extra), ","), F.lit("}"))

    reports = entry.groupBy("o_custkey", "year").agg(natural.alias("natural"), technical.alias("technical"))
    place = F.concat(
        F.lit('{"commune":{"libelle":"C'), F.col("o_custkey").cast("string"), F.lit('","codePostal":"'),
        F.lpad((F.col("o_custkey") % 100).cast("string"), 2, "0"), F.lit('000"}'),
    )
    return reports.select(
        F.concat(
            F.lit('{"'), F.col("o_custkey").cast("string"), F.lit('":'), place,
            F.lit(',"risquesNaturels":'), section(F.col("natural"), F.array(F.lit('"note":"text"'))),
            F.lit(',"risquesTechnologiques":'), section(F.col("technical"), F.array().cast("array<string>")), F.lit("}}"),
        ).alias("document"),
        F.make_date("year", F.lit(1), F.lit(1)).alias("extraction_date"),
    )


def _parsed(t: Tables) -> DataFrame:
    return normalize.parse_reports(normalize.split_reports(_risk_reports(t)))


REPORT_LINES = f"""
lines AS (
  SELECT CAST(o_custkey AS VARCHAR) AS insee_code, make_date(year(o_orderdate), 1, 1) AS extraction_date,
         CASE l_linestatus WHEN 'O' THEN 'naturel' ELSE 'technologique' END AS risk_category,
         {RISK_NAMES} AS risk_key,
         CASE WHEN max(l_quantity) > 5 THEN 'Risk ' || {RISK_NAMES} ELSE {RISK_NAMES} END AS libelle,
         CASE WHEN max(l_quantity) > 45 THEN false ELSE bool_or(l_discount >= 0.05) END AS present,
         ['Risque Important', 'MODÉRÉ', 'Inexistant', '', 'non connu'][CAST(max(l_orderkey % 5) + 1 AS INTEGER)] AS statut_commune,
         CASE WHEN min(l_orderkey % 3) = 0 THEN 'zone Faible' ELSE '' END AS statut_adresse
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  GROUP BY o_custkey, year(o_orderdate), l_linestatus, l_linenumber),
scored AS (
  SELECT *, CASE statut_commune WHEN 'Risque Important' THEN 3 WHEN 'MODÉRÉ' THEN 2 WHEN 'Inexistant' THEN 1
            WHEN 'non connu' THEN 0 ELSE CASE statut_adresse WHEN '' THEN 0 ELSE 1 END END AS severity_score
  FROM lines),
risks AS (
  SELECT *, CASE severity_score WHEN 3 THEN 'eleve' WHEN 2 THEN 'modere' WHEN 1 THEN 'faible' ELSE 'inconnu' END
            AS severity_label FROM scored)"""


@query(f"WITH {REPORT_LINES} SELECT * FROM risks")
def risk_explode(t: Tables) -> DataFrame:
    return normalize.risk_rows(_parsed(t))


def _risk_types(t: Tables) -> DataFrame:
    """(key, label): part types stand in for labels; keys without a type of their index have none."""
    names = F.array(*[F.lit(n) for n in ("seisme", "radon", "icpe")])
    types = t.part.groupBy().agg(F.array_sort(F.collect_set("p_type")).alias("types"))
    return types.select(F.inline(F.arrays_zip(names.alias("key"), F.slice("types", 1, 3).alias("label"))))


@query(
    f"""WITH {REPORT_LINES},
    types AS (SELECT list_sort(list(DISTINCT p_type)) AS l FROM part)
    SELECT * EXCLUDE (libelle),
      CASE risk_key WHEN 'seisme' THEN (SELECT l[1] FROM types) WHEN 'radon' THEN (SELECT l[2] FROM types)
                    WHEN 'icpe' THEN (SELECT l[3] FROM types) ELSE libelle END AS risk_libelle
    FROM risks"""
)
def detail_build(t: Tables) -> DataFrame:
    return normalize.detail_rows(_parsed(t), _risk_types(t))


def _pivot_sql(rows: str, keys: str, last) -> str:
    """Indicator columns from rows with the last entry per risk key already picked by ``last``."""
    out = []
    for key, (stem, parts) in normalize.INDICATORS.items():
        picked = {part: last(key, part) for part in ("present", "severity_score", "statut_commune", "statut_adresse")}
        if "present" in parts:
            out.append(f"coalesce({picked['present']}, false) AS {stem}_present")
        if "severity" in parts:
            out.append(f"coalesce({picked['severity_score']}, 0) AS {stem}_severity")
        if "statut" in parts:
            out.append(f"coalesce(nullif({picked['statut_commune']}, ''), {picked['statut_adresse']}, '') AS {stem}_statut")
    return f"SELECT {keys}, {', '.join(out)} FROM {rows} GROUP BY {keys}"


def _last_by_category(key: str, column: str) -> str:
    return f"max_by({column}, risk_category) FILTER (WHERE risk_key = '{key}')"


_METRICS_SQL = """
  CAST(count(*) FILTER (WHERE present AND risk_category = 'naturel') AS INTEGER) AS naturels_count,
  CAST(count(*) FILTER (WHERE present AND risk_category = 'technologique') AS INTEGER) AS technologiques_count,
  CAST(count(*) FILTER (WHERE present) AS INTEGER) AS total_risks,
  coalesce(max(severity_score) FILTER (WHERE present AND risk_category = 'naturel'), 0) AS max_severity_naturels,
  coalesce(max(severity_score) FILTER (WHERE present AND risk_category = 'technologique'), 0) AS max_severity_technologiques"""


@query(
    f"""WITH {REPORT_LINES},
    wide AS ({_pivot_sql('risks', 'insee_code, extraction_date', _last_by_category)}),
    metrics AS (SELECT insee_code, extraction_date, {_METRICS_SQL} FROM risks GROUP BY insee_code, extraction_date)
    SELECT insee_code, extraction_date, 'C' || insee_code AS commune,
           lpad(CAST(CAST(insee_code AS BIGINT) % 100 AS VARCHAR), 2, '0') || '000' AS code_postal,
           lpad(CAST(CAST(insee_code AS BIGINT) % 100 AS VARCHAR), 2, '0') AS department_code,
           coalesce(n_name, 'inconnu') AS department_name, coalesce(r_name, 'inconnu') AS region,
           wide.* EXCLUDE (insee_code, extraction_date), metrics.* EXCLUDE (insee_code, extraction_date)
    FROM wide JOIN metrics USING (insee_code, extraction_date)
    LEFT JOIN nation ON n_nationkey >= 10 AND CAST(n_nationkey AS VARCHAR) = lpad(CAST(CAST(insee_code AS BIGINT) % 100 AS VARCHAR), 2, '0')
    LEFT JOIN region ON n_regionkey = r_regionkey"""
)
def profile_build(t: Tables) -> DataFrame:
    return normalize.profile_rows(_parsed(t), _departments(t))


@query(
    f"""WITH {REPORT_LINES}
    SELECT insee_code, extraction_date, {_METRICS_SQL.replace('AS INTEGER', 'AS BIGINT')}
    FROM risks GROUP BY insee_code, extraction_date"""
)
def risk_metrics(t: Tables) -> DataFrame:
    return normalize.risk_metrics(normalize.risk_rows(_parsed(t)), ["insee_code", "extraction_date"])


@query(f"WITH {REPORT_LINES} {_pivot_sql('risks', 'insee_code, extraction_date', _last_by_category)}")
def risk_pivot(t: Tables) -> DataFrame:
    rows = normalize.risk_rows(_parsed(t))
    return normalize.risk_pivot(rows, ["insee_code", "extraction_date"], ["risk_category"])


@query(
    """SELECT o_orderkey, coalesce(n_name, 'inconnu') AS department_name, coalesce(r_name, 'none') AS region
    FROM orders LEFT JOIN (nation JOIN region ON n_regionkey = r_regionkey)
      ON CAST(o_custkey % 40 AS VARCHAR) = CAST(n_nationkey AS VARCHAR)"""
)
def dictionary_enrich(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", (F.col("o_custkey") % 40).cast("string").alias("code"))
    named = enrich.enrich(
        rows, _departments(t), F.col("code"), "code", {"department_name": ("name", "inconnu"), "region": ("region", "none")}
    )
    return named.drop("code")


@query(
    f"""WITH {ALERTS}
    SELECT s_name AS gie_name, a.department_code, department_name, phenomenon_name, begin_time, end_time,
           color_name AS alert_level, color_hex, a.extracted_at, a.extraction_date
    FROM (SELECT * REPLACE (CAST(user_id AS VARCHAR) AS department_code) FROM alerts JOIN events ON id = event_id) a
    JOIN supplier ON a.department_code = CAST(s_suppkey // 2 AS VARCHAR)"""
)
def store_alerts(t: Tables) -> DataFrame:
    """Two stores per department; departments are users, so that their number grows with the tables."""
    stores = t.supplier.select(
        F.col("s_name").alias("gie_name"), F.floor(F.col("s_suppkey") / 2).cast("string").alias("department_code")
    )
    users = t.events.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("code"))
    alerts = t.alerts.join(users, "id").withColumn("department_code", F.col("code"))
    return enrich.alerts_by_store(alerts, stores)


_STORE_COUNTS = "naturels_count technologiques_count total_risks max_severity_naturels max_severity_technologiques " \
                "seisme_severity rga_severity radon_severity inondation_severity".split()
_STORE_FLAGS = "seisme_present rga_present radon_present inondation_present icpe_present nucleaire_present".split()


@query(
    f"""WITH {PROFILES},
    newest AS (SELECT * REPLACE (trim(insee_code) AS insee_code) FROM commune_profiles
               WHERE extraction_date = (SELECT max(extraction_date) FROM commune_profiles)),
    stores AS (SELECT s_name AS gie_name, CAST(s_suppkey * 3 AS VARCHAR) AS insee_code,
                      CASE WHEN s_acctbal > 5000 THEN 'Town ' || s_name END AS commune,
                      CASE WHEN s_acctbal > 2000 THEN CAST(10000 + s_suppkey AS VARCHAR) END AS postal_code FROM supplier)
    SELECT gie_name, s.insee_code, coalesce(s.commune, p.commune, '') AS commune,
           coalesce(s.postal_code, p.code_postal, '') AS postal_code,
           coalesce(p.department_code, left(s.postal_code, 2), '') AS department_code,
           coalesce(p.department_name, 'inconnu') AS department_name, coalesce(p.region, 'inconnu') AS region,
           {', '.join(f'coalesce(p.{c}, 0) AS {c}' for c in _STORE_COUNTS)},
           {', '.join(f'coalesce(p.{c}, false) AS {c}' for c in _STORE_FLAGS)}, coalesce(p.commune, '') AS rga_statut
    FROM stores s LEFT JOIN newest p ON s.insee_code = p.insee_code"""
)
def store_risks(t: Tables) -> DataFrame:
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    stores = t.supplier.select(
        F.col("s_name").alias("gie_name"),
        (key * 3).cast("string").alias("insee_code"),
        F.when(balance > 5000, F.concat(F.lit("Town "), "s_name")).alias("commune"),
        F.when(balance > 2000, (key + 10000).cast("string")).alias("postal_code"),
    )
    profiles = snapshot.latest_snapshot(t.commune_profiles, "extraction_date")
    profiles = profiles.withColumns({"insee_code": F.trim("insee_code"), "rga_statut": F.col("commune")})
    return enrich.risks_by_store(stores, profiles)


@query(
    """WITH d AS (SELECT doc_id, lower(text) AS s FROM documents),
    c AS (SELECT doc_id,
          CASE WHEN contains(s, 'important') OR contains(s, 'élevé') OR contains(s, 'eleve') THEN 3
               WHEN contains(s, 'modéré') OR contains(s, 'modere') OR contains(s, 'moyen') THEN 2
               WHEN contains(s, 'faible') OR contains(s, 'existant') THEN 1 ELSE 0 END AS score FROM d)
    SELECT doc_id, CAST(score AS INTEGER) AS severity_score,
           CASE score WHEN 3 THEN 'eleve' WHEN 2 THEN 'modere' WHEN 1 THEN 'faible' ELSE 'inconnu' END AS severity_label
    FROM c"""
)
def severity_class(t: Tables) -> DataFrame:
    level = X.severity(F.col("text"))
    return t.documents.select("doc_id", level["score"].alias("severity_score"), level["label"].alias("severity_label"))


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
      SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"""
)
def keep_first(t: Tables) -> DataFrame:
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    kept = snapshot.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")


@query(f"WITH {QUOTES} SELECT DISTINCT author_slug FROM quotes WHERE author_slug <> ''")
def author_slugs(t: Tables) -> DataFrame:
    return snapshot.distinct_keys(t.quotes, "author_slug")


# Upserts: the table holds orders up to 1998; the batch holds those from 1998 on, changed, each
# order twice (two extractions), and some with a NULL key.

UPSERT_TABLES = """
target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS extracted_at FROM orders
  WHERE o_orderdate < TIMESTAMP '1999-01-01'),
batch AS (
  SELECT CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_orderkey END AS o_orderkey, o_custkey + n AS o_custkey,
         CASE WHEN o_orderstatus = 'P' THEN NULL ELSE lower(o_orderstatus) END AS o_orderstatus,
         o_totalprice + n AS o_totalprice, o_orderdate + to_days(CAST(n AS INTEGER)) AS extracted_at
  FROM orders, (VALUES (1), (2)) v(n) WHERE o_orderdate >= TIMESTAMP '1998-01-01'),
fresh AS (SELECT * FROM batch WHERE o_orderkey IS NOT NULL AND
          extracted_at = (SELECT max(extracted_at) FROM batch b WHERE b.o_orderkey = batch.o_orderkey))"""


def _upsert_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    day = F.col("o_orderdate")
    target = t.orders.where(day < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", day.alias("extracted_at")
    )
    twice = t.orders.where(day >= F.lit("1998-01-01").cast("timestamp_ntz")).withColumn(
        "n", F.explode(F.array(F.lit(1), F.lit(2)))
    )
    batch = twice.select(
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderkey")).alias("o_orderkey"),
        (F.col("o_custkey") + F.col("n")).alias("o_custkey"),
        F.when(F.col("o_orderstatus") != "P", F.lower("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") + F.col("n")).alias("o_totalprice"),
        (day + F.make_dt_interval(days=F.col("n"))).alias("extracted_at"),
    )
    return target, batch


def _upsert_sql(on_conflict: str) -> str:
    return f"""WITH {UPSERT_TABLES}
    SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM fresh)
    UNION ALL SELECT * FROM fresh WHERE o_orderkey NOT IN (SELECT o_orderkey FROM target)
    UNION ALL SELECT {on_conflict} FROM target t JOIN fresh f ON t.o_orderkey = f.o_orderkey
    UNION ALL SELECT * FROM batch WHERE o_orderkey IS NULL"""


@query(_upsert_sql("f.*"))
def upsert_all_cols(t: Tables) -> DataFrame:
    return upsert(*_upsert_tables(t), ["o_orderkey"])


@query(_upsert_sql("t.o_orderkey, t.o_custkey, f.o_orderstatus, f.o_totalprice, f.extracted_at"))
def upsert_subset_cols(t: Tables) -> DataFrame:
    return upsert(*_upsert_tables(t), ["o_orderkey"], ["o_orderstatus", "o_totalprice", "extracted_at"])


@query(_upsert_sql("t.*"))
def upsert_do_nothing(t: Tables) -> DataFrame:
    return upsert(*_upsert_tables(t), ["o_orderkey"], [])


@query(
    """SELECT 'phenomenon' AS type, CAST(list_position(['click','error','purchase','signup','view'], event_type) AS VARCHAR) AS code,
           event_type AS name, CAST(NULL AS INTEGER) AS level, CAST(NULL AS VARCHAR) AS hex_code
    FROM (SELECT DISTINCT event_type FROM events WHERE event_type <> 'view')
    UNION ALL SELECT 'color', CAST(r_regionkey AS VARCHAR), lower(r_name), CAST(r_regionkey + 1 AS INTEGER),
           '#0000' || lpad(CAST(r_regionkey AS VARCHAR), 2, '0') FROM region WHERE r_regionkey BETWEEN 1 AND 3"""
)
def alert_metadata(t: Tables) -> DataFrame:
    return normalize.metadata_rows(_phenomena(t), _colors(t))


# Pages: rendered by Spark from parts and documents, parsed back by the page operators.


def _escaped(c):
    return F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _lit_concat(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _book_pages(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    word = F.element_at(
        F.array(*[F.lit(w) for w in ("One", "Two", "Three", "Four", "Five", "None")]),
        (F.col("p_partkey") % 6 + 1).cast("int"),
    )
    html = _lit_concat(
        "<!DOCTYPE html><html><head><title>x</title><script>var a = '<h1>no</h1>';</script></head><body>",
        '<ul class="breadcrumb"><li><a href="../index.html">Home</a><li>Books</li><li>\n  <a href="#">', F.col("p_type"),
        "</a>\n</li></ul><div class='item active'><img src='../../media/", key, ".jpg'/></div><h1> ", F.col("p_name"),
        ' </h1><p class="star-rating ', word, '"><i class="icon-star"></i></p><div id="product_description" class="sub-header">',
        "<h2>About</h2></div>\n<p>", F.col("p_name"), " &amp; <b>", F.col("p_brand"), "</b></p>",
        '<table class="table table-striped"><tr><th>UPC</th><td>',
        F.when(F.col("p_size") > 2, key).otherwise(""),
        "</td></tr><tr><th>Price (excl. tax)</th><td>£", (F.col("p_size") * 1.5).cast("string"),
        "<tr><th>Price (incl. tax)<td>£", (F.col("p_size") * 1.75).cast("string"), "<tr><th>Tax</th><td>none</td></tr>",
        "<tr><th>Availability</th><td>In stock (", (F.col("p_partkey") % 23).cast("string"), " available)</td></tr></table></body></html>",
    )
    return spread(t.part).select(_lit_concat("https://books.example/catalogue/", key, "/index.html").alias("url"), html.alias("html"))


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS upc, p_name AS title, p_size * 1.5::DOUBLE AS price,
    p_size * 1.75::DOUBLE AS price_incl_tax, CAST(NULL AS DOUBLE) AS tax,
    'In stock (' || CAST(p_partkey % 23 AS VARCHAR) || ' available)' AS availability,
    CAST(p_partkey % 23 AS INTEGER) AS stock_count,
    CASE WHEN p_partkey % 6 = 5 THEN NULL ELSE CAST(p_partkey % 6 + 1 AS INTEGER) END AS star_rating,
    p_type AS category, p_name || ' &' || p_brand AS description,
    'https://books.example/media/' || CAST(p_partkey AS VARCHAR) || '.jpg' AS image_url,
    'https://books.example/catalogue/' || CAST(p_partkey AS VARCHAR) || '/index.html' AS product_url,
    TIMESTAMP '2024-01-07 03:00:00' AS extracted_at, DATE '2024-01-07' AS extraction_date
    FROM part WHERE p_size > 2"""
)
def page_books(t: Tables) -> DataFrame:
    stamp = F.lit("2024-01-07 03:00:00").cast("timestamp_ntz")
    return pages.book_records(_book_pages(t), stamp, "https://books.example")


def _listing_pages(t: Tables) -> DataFrame:
    """Listing pages of up to twenty parts each, one article per part."""
    key = F.col("p_partkey").cast("string")
    href = F.element_at(
        F.array(
            _lit_concat("catalogue/", key, "/index.html"), _lit_concat("../../", key, "/index.html"),
            _lit_concat(key, "/index.html"),
        ),
        (F.col("p_partkey") % 3 + 1).cast("int"),
    )
    article = _lit_concat(
        '<li><article class="product_pod"><div><a href="x"><img src="y"></a></div><h3><a href="', href, '" title="',
        F.col("p_name"), '">', F.left("p_name", F.lit(3)), "...</a></h3></article>",
    )
    listed = t.part.groupBy(F.floor(F.col("p_partkey") / 20).alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("p_partkey", article.alias("article")))).alias("articles")
    )
    body = F.array_join(F.col("articles.article"), "")
    url = _lit_concat("https://books.example/page-", F.col("page").cast("string"))
    return listed.select(url.alias("url"), _lit_concat("<html><body><ol>", body, "</ol></body></html>").alias("html"))


@query(
    """SELECT 'https://books.example/page-' || CAST(p_partkey // 20 AS VARCHAR) AS page_url,
    CAST(row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS INTEGER) AS position,
    'https://books.example/catalogue/' || CAST(p_partkey AS VARCHAR) || '/index.html' AS url, p_name AS title FROM part"""
)
def page_listing(t: Tables) -> DataFrame:
    return pages.listing_links(_listing_pages(t), "https://books.example")


def _quote_pages(t: Tables) -> DataFrame:
    """One page per document with two quotes, the second without an author link."""
    doc = F.col("doc_id").cast("string")
    head = _lit_concat('<div class="quote" itemscope><span class="text" itemprop="text">“', _escaped(F.col("text")), "”</span>")
    html = _lit_concat(
        "<html><body><div class='row'>", head, '<span>by <small class="author">', F.col("source"),
        '</small> <a href="/author/', F.col("lang"), "-", F.col("source"),
        '/">(about)</a></span><div class="tags">Tags: <a class="tag" href="/t">', F.col("lang"),
        '</a> <a class="tag" href="/u"> second </a></div></div><div class="quote"><span class="text">No author</span></div>',
        '<div class="quote"><span class="text">“Short ', doc, '”</span><small class="author">Dr. ', F.col("source"),
        " ", F.upper("lang"), "</small></div></div></body></html>",
    )
    return spread(t.documents).select(_lit_concat("https://quotes.example/page/", doc).alias("url"), html.alias("html"))


_STRIPPED = r"regexp_replace(regexp_replace('“' || text || '”', '^“+', ''), '”+$', '')"


@query(
    rf"""WITH q AS (
      SELECT doc_id, 0 AS position, {_STRIPPED} AS text, source AS author_name, lang || '-' || source AS author_slug,
             '["' || lang || '", "second"]' AS tags FROM documents
      UNION ALL SELECT doc_id, 1, 'Short ' || CAST(doc_id AS VARCHAR), 'Dr. ' || source || ' ' || upper(lang),
             'Dr-' || source || '-' || upper(lang), '[]' FROM documents)
    SELECT 'https://quotes.example/page/' || CAST(doc_id AS VARCHAR) AS page_url, CAST(position AS INTEGER) AS position,
           substr(sha256(text || '|' || author_name), 1, 16) AS quote_hash, text, author_name, author_slug, tags,
           TIMESTAMP '2024-01-07 05:00:00' AS extracted_at, DATE '2024-01-07' AS extraction_date FROM q"""
)
def page_quotes(t: Tables) -> DataFrame:
    return pages.quote_records(_quote_pages(t), F.lit("2024-01-07 05:00:00").cast("timestamp_ntz"))


@query(
    """SELECT 'c' || CAST(c_custkey AS VARCHAR) AS slug,
    CASE WHEN c_acctbal > 0 THEN c_name ELSE 'c' || CAST(c_custkey AS VARCHAR) END AS name,
    'day ' || CAST(c_custkey AS VARCHAR) AS born_date,
    CASE WHEN c_acctbal > 5000 THEN c_mktsegment ELSE '' END AS born_location, c_name || c_mktsegment AS description,
    TIMESTAMP '2024-01-07 05:00:00' AS extracted_at, DATE '2024-01-07' AS extraction_date FROM customer"""
)
def page_authors(t: Tables) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    html = _lit_concat(
        "<div class=author-details>",
        F.when(F.col("c_acctbal") > 0, _lit_concat('<h3 class="author-title">', F.col("c_name"), "</h3>")).otherwise(""),
        '<p>Born: <span class="author-born-date">day ', key, "</span>",
        F.when(F.col("c_acctbal") > 5000, _lit_concat(' <span class="author-born-location">in ', F.col("c_mktsegment"), "</span>")).otherwise(""),
        '</p><div class="author-description">\n ', F.col("c_name"), " <i> ", F.col("c_mktsegment"), " </i></div></div>",
    )
    bios = spread(t.customer).select(_lit_concat("c", key).alias("slug"), html.alias("html"))
    return pages.author_records(bios, F.lit("2024-01-07 05:00:00").cast("timestamp_ntz"))


@query(
    """SELECT page_url, CAST(row_number() OVER (PARTITION BY page_url, page_id ORDER BY i) - 1 AS INTEGER) AS position,
    'https://books.toscrape.com/catalogue/' || href AS url, '' AS title FROM (
      SELECT page_id, url AS page_url, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) AS i FROM (
        SELECT page_id, url, regexp_extract_all(html, '<li><a href="([^"]*)"', 1) AS hrefs FROM pages))"""
)
def page_links(t: Tables) -> DataFrame:
    """List links of the given raw pages, every list item marked as a product."""
    opened = F.replace("html", F.lit("<li>"), F.lit('<article class="product_pod"><h3>'))
    marked = F.replace(opened, F.lit("</li>"), F.lit("</h3></article>"))
    return pages.listing_links(t.pages.select("url", marked.alias("html")))


@query(
    rf"""WITH q AS (
      SELECT doc_id, 0 AS position, {_STRIPPED} AS text, source AS author_name, lang || '-' || source AS author_slug FROM documents
      UNION ALL SELECT doc_id, 1, 'Short ' || CAST(doc_id AS VARCHAR), 'Dr. ' || source || ' ' || upper(lang),
             'Dr-' || source || '-' || upper(lang) FROM documents),
    h AS (SELECT *, substr(sha256(text || '|' || author_name), 1, 16) AS quote_hash FROM q)
    SELECT quote_hash, text, author_name, author_slug FROM h
    QUALIFY row_number() OVER (PARTITION BY quote_hash ORDER BY doc_id, position) = 1"""
)
def landed_quotes(t: Tables) -> DataFrame:
    """Quote pages to unique quotes."""
    numbered = _quote_pages(t).withColumn("page_no", F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint"))
    landed = pages.land_quotes(numbered, F.lit("2024-01-07 05:00:00").cast("timestamp_ntz"))
    return landed.select("quote_hash", "text", "author_name", "author_slug")
