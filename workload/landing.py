"""From raw documents and pages through landing tables to reports, and loads that run again."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.operators import anomaly, contracts, normalize
from lakeweir.operators.health import TooFewRecordsError
from lakeweir.plans import ingest as jobs
from lakeweir.plans import history, marts, refresh, staging
from lakeweir.session import working_path
from lakeweir.sources import sinks
from lakeweir.sources.members import object_members
from lakeweir.sources.schemas import LANDING
from lakeweir.sources.versions import read_table
from lakeweir.streaming import dedup_with_late_rows, late_rows, stream_files
from workload import ingest, models, quality  # noqa: F401 - quality registers SQL that is used here
from workload.registry import SQL, query
from workload.tables import ALERTS, AUTHORS, BOOKS, DETAILS, METRICS, PROFILES, QUOTES, Tables

# Loads that run again: every landing table takes the same batch twice. Some keys repeat within the
# batch, and some rows have a NULL in their key; neither may add rows the second time.


def landed_sql(name: str, source: str) -> str:
    """What the landing table ``name`` holds after loading ``source``, without its row id.

    Of a key the newest row stays, then the greatest; rows with a NULL in the key all stay.
    """
    table = LANDING[name]
    rest = sorted((c for c in table.columns if c not in table.key), key=lambda c: c != "extracted_at")
    order = ", ".join(f"{c} DESC NULLS LAST" for c in rest)
    partial = " OR ".join(f"{k} IS NULL" for k in table.key)
    stamp = ", extracted_at AS created_at" if table.row_id else ""
    columns = ", ".join(table.columns)
    return f"""SELECT {columns}{stamp} FROM ({source}) AS source
    QUALIFY {partial} OR row_number() OVER (PARTITION BY {', '.join(table.key)} ORDER BY {order}) = 1"""


SOURCES: dict[str, tuple[str, Callable[[Tables], DataFrame]]] = {}


def _rerun(name: str, source: str):
    """Register ``rerun_<name>``: load what the function gives twice, return the landing table."""

    def register(build: Callable[[Tables], DataFrame]):
        SOURCES[name] = (source, build)

        def twice(t: Tables) -> DataFrame:
            base, rows = working_path(t.spark, "rerun"), sinks.staged(build(t).select(*LANDING[name].columns), "rerun-batch")
            for _ in range(2):
                sinks.upsert_landing(rows, base, name, reread=True)
            return sinks.read_landing(t.spark, base, name).drop("id")

        twice.__name__ = f"rerun_{name}"
        return query(landed_sql(name, source))(twice)

    return register


def _without(df: DataFrame, column: str, where: str) -> DataFrame:
    return df.withColumn(column, F.when(~F.coalesce(F.expr(where), F.lit(False)), F.col(column)))


def _null(column: str, where: str) -> str:
    return f"CASE WHEN {where} THEN NULL ELSE {column} END AS {column}"


@_rerun(
    "alerts",
    f"""WITH {ALERTS} SELECT * REPLACE (
      CASE WHEN id % 13 = 0 THEN NULL ELSE date_trunc('hour', begin_time) END AS begin_time) FROM alerts""",
)
def _alerts(t: Tables) -> DataFrame:
    hour = F.date_trunc("hour", "begin_time").cast("timestamp_ntz")
    return t.alerts.withColumn("begin_time", F.when(F.col("id") % 13 != 0, hour))


@_rerun("store_alerts", f"SELECT * REPLACE ({_null('begin_time', 'alert_level = $$rouge$$')}) FROM ({SQL['store_alerts']})")
def _store_alerts(t: Tables) -> DataFrame:
    return _without(ingest.store_alerts(t), "begin_time", "alert_level = 'rouge'")


@_rerun("alert_metadata", f"SELECT * REPLACE ({_null('code', 'code = $$2$$')}) FROM ({SQL['alert_metadata']})")
def _alert_metadata(t: Tables) -> DataFrame:
    return _without(ingest.alert_metadata(t), "code", "code = '2'")


@_rerun(
    "commune_profiles",
    f"WITH {PROFILES} SELECT * REPLACE ({_null('insee_code', 'id % 11 = 0')}), region AS rga_statut FROM commune_profiles",
)
def _commune_profiles(t: Tables) -> DataFrame:
    return _without(t.commune_profiles, "insee_code", "id % 11 = 0").withColumn("rga_statut", F.col("region"))


@_rerun(
    "store_risks",
    f"""SELECT * REPLACE ({_null('gie_name', 'postal_code = $$$$')}), TIMESTAMP '2024-01-07 03:00:00' AS extracted_at,
    DATE '2024-01-07' AS extraction_date FROM ({SQL['store_risks']})""",
)
def _store_risks(t: Tables) -> DataFrame:
    stamp = F.lit("2024-01-07 03:00:00").cast("timestamp_ntz")
    rows = _without(ingest.store_risks(t), "gie_name", "postal_code = ''")
    return rows.withColumns({"extracted_at": stamp, "extraction_date": stamp.cast("date")})


@_rerun("risk_details", f"WITH {DETAILS} SELECT * REPLACE ({_null('risk_key', 'risk_key LIKE $$%7$$')}) FROM risk_details")
def _risk_details(t: Tables) -> DataFrame:
    return _without(t.risk_details, "risk_key", "risk_key LIKE '%7'")


@_rerun("books", f"WITH {BOOKS} SELECT * REPLACE ({_null('upc', 'id % 17 = 0')}) FROM books")
def _books(t: Tables) -> DataFrame:
    return _without(t.books, "upc", "id % 17 = 0")


@_rerun("quotes", f"WITH {QUOTES} SELECT * REPLACE ({_null('quote_hash', 'id % 19 = 0')}) FROM quotes")
def _quotes(t: Tables) -> DataFrame:
    return _without(t.quotes, "quote_hash", "id % 19 = 0")


@_rerun("authors", f"WITH {AUTHORS} SELECT * REPLACE ({_null('slug', 'id % 3 = 0')}) FROM authors")
def _authors(t: Tables) -> DataFrame:
    return _without(t.authors, "slug", "id % 3 = 0")


@_rerun(
    "run_metrics",
    f"""WITH {METRICS} SELECT * REPLACE ({_null('dag_id', 'source = $$view$$')}), CAST(items_extracted AS DOUBLE) AS duration_seconds,
    CAST(run_date AS TIMESTAMP) AS started_at, CAST(NULL AS TIMESTAMP) AS finished_at FROM run_metrics""",
)
def _run_metrics(t: Tables) -> DataFrame:
    return _without(t.run_metrics, "dag_id", "source = 'view'").withColumns({
        "duration_seconds": F.col("items_extracted").cast("double"),
        "started_at": F.col("run_date").cast("timestamp_ntz"),
        "finished_at": F.lit(None).cast("timestamp_ntz"),
    })


# Raw documents to reports, one query per domain: ingestion job, landing tables, staging, marts.

AS_OF = "2024-01-31 06:00:00"


def _as_cte(name: str, sql: str, row_id: bool = True) -> str:
    return f"\n{name} AS (SELECT {'0 AS id, ' if row_id else ''}* FROM ({sql}))"


def _with(text: str, **tables: str) -> str:
    """``text`` with the definitions of given landing tables replaced."""
    given = {"alerts": ALERTS, "commune_profiles": PROFILES, "risk_details": DETAILS, "books": BOOKS, "quotes": QUOTES, "authors": AUTHORS}
    for name, sql in tables.items():
        if given[name] not in text:
            raise ValueError(name)
        text = text.replace(given[name], sql)
    return text


_NEWEST_YEAR = "(SELECT max(make_date(year(o_orderdate), 1, 1)) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"


def _newest(sql: str) -> str:
    return f"SELECT *, CAST(extraction_date AS TIMESTAMP) AS extracted_at FROM ({sql}) WHERE extraction_date = {_NEWEST_YEAR}"


@query(
    _with(
        SQL["risk_summary"],
        alerts=_as_cte("alerts", landed_sql("alerts", SQL["alert_explode"])),
        commune_profiles=_as_cte("commune_profiles", landed_sql("commune_profiles", _newest(SQL["profile_build"]))),
        risk_details=_as_cte("risk_details", landed_sql("risk_details", _newest(SQL["detail_build"]))),
    )
)
def documents_to_risk_summary(t: Tables) -> DataFrame:
    """Alert documents and risk reports to the risk summary, through landing tables on files."""
    base = working_path(t.spark, "documents-landing")

    def stamped(documents: DataFrame) -> DataFrame:
        return documents.withColumn("extracted_at", F.col("extraction_date").cast("timestamp_ntz"))

    reports = ingest._risk_reports(t)
    newest = reports.agg(F.max("extraction_date")).scalar()
    stores = t.supplier.select(
        F.col("s_name").alias("gie_name"), (F.col("s_suppkey") % 30).cast("string").alias("department_code"),
        F.col("s_suppkey").cast("string").alias("insee_code"), F.lit(None).cast("string").alias("commune"),
        F.lit(None).cast("string").alias("postal_code"),
    )
    dictionaries = {
        "phenomena": ingest._phenomena(t), "colors": ingest._colors(t), "departments": ingest._departments(t),
        "risk_types": ingest._risk_types(t), "stores": stores,
    }
    alerts = ingest.normalize.open_alert_documents(stamped(ingest._alert_documents(t)))
    jobs.ingest_alerts(alerts, dictionaries, base, AS_OF)
    jobs.ingest_risks(stamped(reports.where(F.col("extraction_date") == newest)), dictionaries, base, AS_OF)
    landing = {n: sinks.read_landing(t.spark, base, n) for n in ("alerts", "commune_profiles", "risk_details")}
    communes = marts.dim_communes(
        staging.stg_commune_profiles(landing["commune_profiles"]), staging.stg_risk_details(landing["risk_details"])
    )
    report = marts.rpt_risk_summary(marts.fct_alerts(staging.stg_alerts(landing["alerts"])), communes)
    averages = ("avg_risks_per_commune", "avg_severity_naturels", "avg_severity_technologiques")
    return report.withColumns({c: F.col(c).cast("double") for c in averages})


def _detail_pages(t: Tables) -> DataFrame:
    """The rendered book pages at the site that listings link to, with a tax, and a rating on each."""
    html = F.replace(F.replace("html", F.lit("<td>none</td>"), F.lit("<td>£0.25</td>")), F.lit("star-rating None"), F.lit("star-rating One"))
    url = F.replace("url", F.lit("https://books.example"), F.lit(ingest.pages.BOOKS_SITE))
    return ingest._book_pages(t).select(url.alias("url"), html.alias("html"))


_PAGE_BOOKS = f"""SELECT * REPLACE (0.25::DOUBLE AS tax, coalesce(star_rating, 1) AS star_rating) FROM ({SQL['page_books']})
    WHERE length(upc) >= 2"""


@query(_with(SQL["book_stats"], books=_as_cte("books", landed_sql("books", _PAGE_BOOKS))))
def pages_to_book_stats(t: Tables) -> DataFrame:
    """Listing and detail pages to the book report, through the landing table on files."""
    base = working_path(t.spark, "books-landing")
    listings = ingest._listing_pages(t).withColumn("page_no", F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint"))
    jobs.ingest_books(listings, _detail_pages(t), base, "2024-01-07 03:00:00")
    books = sinks.read_landing(t.spark, base, "books")
    report = marts.rpt_book_stats(marts.dim_books(staging.stg_books(books)))
    return report.withColumns({c: F.col(c).cast("double") for c in ("avg_price", "avg_rating")})


_PAGE_QUOTES = f"""SELECT * FROM ({SQL['page_quotes']}) QUALIFY row_number() OVER (PARTITION BY quote_hash, text, author_name
    ORDER BY CAST(regexp_extract(page_url, '[0-9]+$') AS BIGINT), position) = 1"""
_PAGE_AUTHORS = """SELECT lang || '-' || source AS slug, source AS name, 'day ' || CAST(min(doc_id) AS VARCHAR) AS born_date,
    upper(lang) AS born_location, 'of ' || lang AS description, TIMESTAMP '2024-01-07 05:00:00' AS extracted_at,
    DATE '2024-01-07' AS extraction_date FROM documents GROUP BY source, lang"""


@query(
    f"""WITH {_with(
        models.STG_QUOTES, quotes=_as_cte("quotes", landed_sql("quotes", _PAGE_QUOTES)),
        authors=_as_cte("authors", landed_sql("authors", _PAGE_AUTHORS)))}
    SELECT author_name, author_born_date, author_born_location, count(*) AS quote_count,
           CAST(round(CAST(avg(quote_length) AS DECIMAL(18,3)), 1) AS DOUBLE) AS avg_quote_length,
           min(quote_length) AS min_quote_length, max(quote_length) AS max_quote_length
    FROM stg_quotes WHERE author_slug IS NOT NULL GROUP BY author_name, author_born_date, author_born_location"""
)
def pages_to_quote_stats(t: Tables) -> DataFrame:
    """Quote and author pages to the quote report, through landing tables on files."""
    base = working_path(t.spark, "quotes-landing")
    numbered = ingest._quote_pages(t).withColumn("page_no", F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint"))
    html = ingest._lit_concat(
        '<h3 class="author-title">', F.col("source"), '</h3><span class="author-born-date">day ', F.col("first").cast("string"),
        '</span><span class="author-born-location">in ', F.upper("lang"), '</span><div class="author-description">of ', F.col("lang"), "</div>",
    )
    authors = t.documents.groupBy("source", "lang").agg(F.min("doc_id").alias("first")).select(
        F.concat("lang", F.lit("-"), "source").alias("slug"), html.alias("html")
    )
    jobs.ingest_quotes(numbered, authors, base, "2024-01-07 05:00:00")
    staged = staging.stg_quotes(sinks.read_landing(t.spark, base, "quotes"), sinks.read_landing(t.spark, base, "authors"))
    report = marts.rpt_quote_stats(marts.dim_authors(staged), marts.fct_quotes(staged))
    return report.withColumn("avg_quote_length", F.col("avg_quote_length").cast("double"))


# Two extractions and a modelling run after each. Prices rise, a third of the quotes and the later
# alerts differ; the reports show the second extraction, not both.


def _second(df: DataFrame) -> DataFrame:
    week = F.make_dt_interval(days=F.lit(7))
    return df.withColumns({
        "extracted_at": F.col("extracted_at") + week, "created_at": F.col("created_at") + week,
        "extraction_date": F.date_add("extraction_date", 7),
    })


_DEARER = BOOKS.replace("p_size * 1.5::DOUBLE AS price", "p_size * 1.5::DOUBLE + 2 AS price")
_FEWER = QUOTES.replace("FROM documents)", "FROM documents WHERE doc_id % 3 <> 0)")
_FEWER_LANDED = _as_cte("quotes", landed_sql("quotes", f"WITH {_FEWER} SELECT * FROM quotes"))


@query(
    f"""SELECT 'rpt_book_stats' AS report, category AS name, book_count AS number, avg_price AS value
    FROM ({_with(SQL['book_stats'], books=_DEARER)})
    UNION ALL SELECT 'rpt_quote_stats', author_name || coalesce(author_born_date, ''), count(*),
      CAST(round(CAST(avg(quote_length) AS DECIMAL(18,3)), 1) AS DOUBLE)
      FROM (WITH {_with(models.STG_QUOTES, quotes=_FEWER_LANDED)}
            SELECT * FROM stg_quotes WHERE author_slug IS NOT NULL)
      GROUP BY author_name, author_born_date
    UNION ALL SELECT 'rpt_risk_summary', department_code, active_alert_count, avg_risks_per_commune FROM ({SQL['risk_summary']})"""
)
def refreshed_values(t: Tables) -> DataFrame:
    """Reports after two extractions, each landed and followed by a modelling run."""
    base = working_path(t.spark, "refresh-values")
    first = {n: getattr(t, n) for n in ("alerts", "commune_profiles", "risk_details", "books", "quotes", "authors")}
    first["commune_profiles"] = first["commune_profiles"].withColumn("rga_statut", F.lit(""))
    second = {
        "books": _second(first["books"]).withColumn("price", F.col("price") + 2),
        "quotes": _second(first["quotes"]).where("id % 3 <> 0"),
        "authors": _second(first["authors"]),
        "alerts": first["alerts"].where("extraction_date > DATE '2024-01-20'"),
    }
    first["alerts"] = first["alerts"].where("extraction_date <= DATE '2024-01-20'")
    for extraction, as_of in ((first, "2024-01-21 06:00:00"), (second, AS_OF)):
        for name, rows in extraction.items():
            plain = name in ("alerts", "books", "quotes")  # read from the given tables with no shuffle
            sinks.upsert_landing(rows, f"{base}/landed", name, created_at=F.col("created_at"), reread=plain)
        landing = {name: sinks.read_landing(t.spark, f"{base}/landed", name) for name in first}
        refresh.refresh(t.spark, landing, f"{base}/models", as_of, by_date=True)

    def report(name: str, label: Column, number: str, value: str) -> DataFrame:
        rows = read_table(t.spark, f"{base}/models/marts/{name}")
        return rows.select(F.lit(name).alias("report"), label.alias("name"), F.col(number).alias("number"), F.col(value).cast("double").alias("value"))

    return reduce(DataFrame.unionByName, [
        report("rpt_book_stats", F.col("category"), "book_count", "avg_price"),
        report("rpt_quote_stats", F.concat("author_name", F.coalesce("author_born_date", F.lit(""))), "quote_count", "avg_quote_length"),
        report("rpt_risk_summary", F.col("department_code"), "active_alert_count", "avg_risks_per_commune"),
    ])


# State that each extraction is merged into, instead of reading all dates again.


def _state(t: Tables) -> DataFrame:
    """History after three runs: the first years, all years, and all years again."""
    path, profiles = working_path(t.spark, "history"), staging.stg_commune_profiles(t.commune_profiles)
    for rows in (profiles.where("extraction_date < DATE '1996-01-01'"), profiles, profiles):
        state = history.refresh_history(t.spark, rows, path)
    return history.extraction_history(state)


@query(SQL["extraction_history"])
def extraction_history_state(t: Tables) -> DataFrame:
    return _state(t)


@query(SQL["dim_communes"])
def dim_communes_state(t: Tables) -> DataFrame:
    profiles, details = staging.stg_commune_profiles(t.commune_profiles), staging.stg_risk_details(t.risk_details)
    return marts.dim_communes(profiles, details, _state(t))


# A stream of ten files, three days each; every tenth event arrives two files late. The watermark
# follows the newest event by a day. One event per user, type and day stays.

_LAST_FILE, _DELAY_HOURS = 9, 24


@query(
    f"""WITH arrived AS (
      SELECT *, CAST(ts AS DATE) AS day, least({_LAST_FILE}, (day(ts) - 1) // 3 + CASE WHEN event_id % 10 = 0 THEN 2 ELSE 0 END) AS file
      FROM events),
    marks AS (
      SELECT file + 1 AS file, max(max(ts)) OVER (ORDER BY file) - INTERVAL {_DELAY_HOURS} HOUR AS mark FROM arrived GROUP BY file),
    judged AS (SELECT a.*, coalesce(a.ts < m.mark, false) AS is_late, m.mark FROM arrived a LEFT JOIN marks m USING (file))
    SELECT event_id, ts, user_id, event_type, value, props, day, CAST(NULL AS BIGINT) AS late_micros FROM judged WHERE NOT is_late
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type, day ORDER BY ts, event_id, value, props) = 1
    UNION ALL SELECT event_id, ts, user_id, event_type, value, props, day, epoch_us(mark) - epoch_us(ts) FROM judged WHERE is_late"""
)
def stream_late_rows(t: Tables) -> DataFrame:
    """Kept rows and late rows of a stream, with all their columns."""
    folder, kept, late, state = (working_path(t.spark, f"late-{n}") for n in ("in", "kept", "rows", "state"))
    file = F.least(F.lit(_LAST_FILE), F.floor((F.day("ts") - 1) / 3) + F.when(F.col("event_id") % 10 == 0, 2).otherwise(0))
    events = t.events.withColumn("day", F.to_date("ts"))
    for number in range(_LAST_FILE + 1):
        events.where(file == number).coalesce(1).write.mode("append").parquet(folder)
    stream = stream_files(t.spark, folder, events.schema, files_per_batch=1)
    dedup_with_late_rows(
        stream, kept, late, state, ["user_id", "event_type", "day"], "ts", _DELAY_HOURS * 3600, partition_by="day", order=["event_id"],
    ).awaitTermination()
    columns = [*events.columns]
    found = late_rows(t.spark, late, events.schema).select(*columns, "late_micros")
    return read_table(t.spark, kept, events.schema).withColumn("late_micros", F.lit(None).cast("long")).unionByName(found)


# Runs with their metrics row, one of which fails after its rows were written.


@query(
    f"""SELECT event_type AS source, event_type || '_ingestion' AS dag_id, DATE '2024-01-31' AS run_date, count(*) AS items_extracted,
    count(*) FILTER (WHERE value <= 100) AS items_loaded,
    count(*) FILTER (WHERE value > 100) + CASE event_type WHEN 'error' THEN 1 ELSE 0 END AS errors FROM events GROUP BY event_type"""
)
def tracked_runs(t: Tables) -> DataFrame:
    """One tracked run per event type; counts come from the run's own write."""
    base = working_path(t.spark, "tracked")

    def job(source: str):
        def work(run) -> None:
            rows = run.watch(t.events.where(F.col("event_type") == source), "items_extracted")
            fine = F.coalesce(F.col("value") <= 100, F.lit(False))
            run.watch(rows.where(fine), "items_loaded").write.parquet(f"{base}/events-{source}")
            run.errors += t.events.where((F.col("event_type") == source) & (F.col("value") > 100)).count()
            if source == "error":
                raise RuntimeError("the run stops here")

        return work

    # As many as there are event types.
    for source in sorted(r[0] for r in t.events.select("event_type").distinct().collect()):
        try:
            jobs.tracked(t.spark, source, base, AS_OF, job(source))
        except RuntimeError:
            if source != "error":
                raise
    rows = sinks.read_landing(t.spark, base, "run_metrics")
    return rows.select("source", "dag_id", "run_date", "items_extracted", "items_loaded", "errors")


# Pages that cannot be read: kept by page with the reason, and counted in the pass rate of their run.

_UNREADABLE = "p_partkey % 40 = 3"


@query(
    f"""SELECT 'page' AS kind, 'https://books.toscrape.com/catalogue/' || CAST(p_partkey AS VARCHAR) || '/index.html' AS name,
      CAST(1 AS BIGINT) AS number FROM part WHERE p_size > 2 AND {_UNREADABLE}
    UNION ALL SELECT 'run', 'records', count(*) FROM part WHERE p_size > 2
    UNION ALL SELECT 'run', 'valid', count(*) FROM part WHERE p_size > 2 AND p_partkey >= 10 AND NOT ({_UNREADABLE})
    UNION ALL SELECT 'landed', 'books', count(*) FROM part WHERE p_size > 2 AND p_partkey >= 10 AND NOT ({_UNREADABLE})
    UNION ALL SELECT 'documents', 'books', count(*) FROM part WHERE p_size > 2 AND NOT ({_UNREADABLE})"""
)
def page_failures(t: Tables) -> DataFrame:
    """Book pages, some with a tax that is no number, through the ingestion job to all of its sinks."""
    base = working_path(t.spark, "page-failures")
    listings = ingest._listing_pages(t).withColumn("page_no", F.regexp_extract("url", "([0-9]+)$", 1).cast("bigint"))
    number = F.regexp_extract("url", "catalogue/([0-9]+)/", 1).cast("bigint")
    odd = F.when(number % 40 == 3, F.replace("html", F.lit("£0.25"), F.lit("£1.2.3"))).otherwise(F.col("html"))
    jobs.ingest_books(listings, _detail_pages(t).withColumn("html", odd), base, "2024-01-07 03:00:00")

    def counted(kind: str, name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("number")).select(F.lit(kind).alias("kind"), F.lit(name).alias("name"), "number")

    pages = read_table(t.spark, f"{base}/page_errors").select(F.lit("page").alias("kind"), F.col("page").alias("name"), F.lit(1).cast("long").alias("number"))
    log = t.spark.read.parquet(f"{base}/{jobs.RUN_LOG}")
    run = log.select(F.inline(F.array(*[
        F.struct(F.lit("run").alias("kind"), F.lit(name).alias("name"), F.col(column).cast("long").alias("number"))
        for name, column in (("records", "total_records"), ("valid", "valid_records"))
    ])))
    documents = t.spark.read.schema("upc string, domain string, source string").json(f"{base}/raw")
    parts = [pages, run, counted("landed", "books", sinks.read_landing(t.spark, base, "books")), counted("documents", "books", documents)]
    return reduce(DataFrame.unionByName, parts)


# One file with all reports as one object, read by several tasks through their byte ranges.


@query(f"{SQL['risk_explode'].replace('SELECT * FROM risks', '')} SELECT * FROM risks WHERE extraction_date = {_NEWEST_YEAR}")
def reports_of_one_file(t: Tables) -> DataFrame:
    """All reports of the newest year in one JSON object, cut at members and parsed."""
    reports = ingest._risk_reports(t)
    newest = reports.agg(F.max("extraction_date")).first()[0]
    member = F.substring("document", 2, 1 << 30)
    inner = reports.where(F.col("extraction_date") == F.lit(newest)).select(F.substr(member, F.lit(1), F.length(member) - 1).alias("member"))
    folder = working_path(t.spark, "one-file")
    ordered = inner.repartitionByRange(1, "member").sortWithinPartitions("member")
    head = F.when(F.row_number().over(Window.orderBy("member")) == 1, "{").otherwise(",")
    lines = ordered.select(F.concat(head, "member").alias("value"))
    lines.unionByName(t.spark.range(1).select(F.lit("}").alias("value"))).coalesce(1).write.text(folder)
    documents = object_members(t.spark, folder).select("document", "position", F.lit(newest).alias("extraction_date"))
    return normalize.risk_rows(normalize.parse_reports(normalize.split_reports(documents))).drop("position")


# All record contracts over the rows that the landing tables take, and three over deals and recipes made of parts.

_RECIPES = """SELECT CASE WHEN p_partkey % 31 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS recipe_id, p_name AS title,
    'https://cook.example/' || CAST(p_partkey AS VARCHAR) AS recipe_url, p_size AS prep_time_minutes, p_retailprice / 100 AS rating,
    '2024-01-07' AS extraction_date, '2024-01-07T03:00:00' AS extracted_at FROM part"""
_GAMES = """SELECT CAST(p_partkey AS VARCHAR) AS gog_id, CASE WHEN p_partkey % 17 <> 0 THEN p_name END AS title, p_brand AS developer,
    p_retailprice AS price, p_size > 25 AS is_in_development, '2024-01-07' AS extraction_date, '2024-01-07T03:00:00' AS extracted_at FROM part"""
_DEALS = """SELECT CAST(p_partkey AS VARCHAR) AS deal_id, p_name AS title, CASE WHEN p_size > 3 THEN 'https://deal.example/' || p_brand END AS deal_url,
    p_type AS category, p_size AS temperature, '2024-01-07' AS extraction_date, '2024-01-07T03:00:00' AS extracted_at FROM part"""


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns({"extraction_date": F.lit("2024-01-07"), "extracted_at": F.lit("2024-01-07T03:00:00")})


def _recipes(t: Tables) -> DataFrame:
    key = F.col("p_partkey").cast("string")
    return _dated(t.part.select(
        F.when(F.col("p_partkey") % 31 != 0, key).alias("recipe_id"), F.col("p_name").alias("title"),
        F.concat(F.lit("https://cook.example/"), key).alias("recipe_url"), F.col("p_size").alias("prep_time_minutes"),
        (F.col("p_retailprice") / 100).alias("rating"),
    ))


def _games(t: Tables) -> DataFrame:
    return _dated(t.part.select(
        F.col("p_partkey").cast("string").alias("gog_id"), F.when(F.col("p_partkey") % 17 != 0, F.col("p_name")).alias("title"),
        F.col("p_brand").alias("developer"), F.col("p_retailprice").alias("price"), (F.col("p_size") > 25).alias("is_in_development"),
    ))


def _deals(t: Tables) -> DataFrame:
    url = F.when(F.col("p_size") > 3, F.concat(F.lit("https://deal.example/"), "p_brand"))
    return _dated(t.part.select(
        F.col("p_partkey").cast("string").alias("deal_id"), F.col("p_name").alias("title"), url.alias("deal_url"),
        F.col("p_type").alias("category"), F.col("p_size").alias("temperature"),
    ))


CONTRACTED = {
    "book": SOURCES["books"], "quote": SOURCES["quotes"], "author": SOURCES["authors"], "alert": SOURCES["alerts"],
    "store_alert": SOURCES["store_alerts"], "commune_profile": SOURCES["commune_profiles"], "store_risk": SOURCES["store_risks"],
    "risk_detail": SOURCES["risk_details"], "recipe": (_RECIPES, _recipes), "game_deal": (_GAMES, _games), "shop_deal": (_DEALS, _deals),
}
_OPTIONAL = {"recipe": ("recipe_id", "title", "recipe_url"), "game_deal": ("gog_id", "title"), "shop_deal": ("deal_id", "title", "deal_url")}


def _fits_sql(contract: contracts.Contract) -> str:
    """The contract's rules on typed columns, those that the source has."""
    rules = []
    for f in contract.fields:
        if contract.name in _OPTIONAL and f.name not in (*_OPTIONAL[contract.name], "extraction_date", "extracted_at"):
            continue
        if not f.nullable:
            rules.append(f"{f.name} IS NOT NULL")
        if f.min_length is not None:
            rules.append(f"length({f.name}) >= {f.min_length}")
        rules += [f"coalesce({f.name} {sign} {limit}, true)" for sign, limit in ((">=", f.ge), ("<=", f.le)) if limit is not None]
    return " AND ".join(rules)


def _rate_sql(name: str) -> str:
    return (
        f"SELECT '{name}' AS pipeline, count(*) AS total_records, count(*) FILTER (WHERE {_fits_sql(contracts.CONTRACTS[name])}) AS valid_records "
        f"FROM ({CONTRACTED[name][0]})"
    )


_RATES = " UNION ALL ".join(_rate_sql(name) for name in CONTRACTED)


def _rates(t: Tables) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        contracts.pass_rate(contracts.mark_errors(build(t), contracts.CONTRACTS[name]), name) for name, (_, build) in CONTRACTED.items()
    ])


@query(f"SELECT *, total_records - valid_records AS error_records, valid_records::DOUBLE / total_records AS pass_rate FROM ({_RATES})")
def contract_rates(t: Tables) -> DataFrame:
    """Pass rate of every record contract."""
    return _rates(t)


_MINIMA = (0.5, 0.9, 0.97)


@query(
    f"""SELECT pipeline, CAST(minimum AS DOUBLE) AS minimum, valid_records::DOUBLE / total_records >= minimum AS passed
    FROM ({_RATES}), (VALUES {', '.join(f'({m}::DOUBLE)' for m in _MINIMA)}) m(minimum)"""
)
def gate_outcomes(t: Tables) -> DataFrame:
    """What the pass-rate gate lets through at three minimum rates."""
    rates, rows = sinks.staged(_rates(t), "rates"), []
    for name in CONTRACTED:
        for minimum in _MINIMA:
            try:
                contracts.enforce_pass_rate(rates.where(F.col("pipeline") == name), minimum)
                rows.append((name, minimum, True))
            except contracts.QualityGateError:
                rows.append((name, minimum, False))
    return t.spark.createDataFrame(rows, "pipeline string, minimum double, passed boolean")


@query(SQL["anomaly_quarantine"])
def quarantine_files(t: Tables) -> DataFrame:
    """Anomalies and clean rows through the split sink, read back from its two tables."""
    base = working_path(t.spark, "quarantine-files")
    sinks.split_quarantine(anomaly.detect_anomalies(t.events, ["value", "user_id"]), f"{base}/clean", f"{base}/bad")
    bad, clean = read_table(t.spark, f"{base}/bad"), read_table(t.spark, f"{base}/clean")
    both = bad.select(F.lit("quarantine").alias("target"), "event_type", "event_id").unionByName(
        clean.select(F.lit("staging").alias("target"), "event_type", "event_id")
    )
    return both.groupBy("target", "event_type").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


@query(
    """SELECT event_type AS source, count(*) AS items_loaded, count(*) < (SELECT count(*) // 5 FROM events) AS too_few
    FROM events GROUP BY event_type"""
)
def minimum_guard(t: Tables) -> DataFrame:
    """Runs that have to load a fifth of all events: their recorded rows, and which of them raised."""
    base, least, raised = working_path(t.spark, "minimum"), t.events.count() // 5, {}

    def job(source: str):
        def work(run) -> None:
            run.watch(t.events.where(F.col("event_type") == source), "items_loaded").write.parquet(f"{base}/events-{source}")

        return work

    for source in sorted(r[0] for r in t.events.select("event_type").distinct().collect()):
        try:
            jobs.tracked(t.spark, source, base, AS_OF, job(source), minimum=least)
            raised[source] = False
        except TooFewRecordsError:
            raised[source] = True
    named = F.create_map(*[F.lit(x) for pair in raised.items() for x in pair])
    return sinks.read_landing(t.spark, base, "run_metrics").select("source", "items_loaded", F.element_at(named, F.col("source")).alias("too_few"))
