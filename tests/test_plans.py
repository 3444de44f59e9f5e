from datetime import date, datetime, timedelta

import pyarrow.parquet as parquet
import pytest
from pyspark.sql import functions as F

from lakeweir.operators.contracts import QualityGateError
from lakeweir.operators.normalize import open_alert_documents
from lakeweir.plans import ingest
from lakeweir.plans.monitor import source_health
from lakeweir.sources import sinks
from lakeweir.sources.catalog import Catalog, Dataset
from lakeweir.sources.schemas import LANDING, MONITORING
from tests.conftest import rows
from tests.test_pages import DETAIL

AS_OF = "2024-01-07 03:00:00"


def table(spark, base, name):
    return spark.read.schema(LANDING[name].ddl).parquet(f"{base}/{name}")


def value(kind, n):
    return {"string": f"v{n}", "int": n, "bigint": n, "double": float(n), "boolean": bool(n % 2),
            "date": date(2024, 1, 1) + timedelta(days=n), "timestamp_ntz": datetime(2024, 1, 1) + timedelta(hours=n)}[kind]


@pytest.mark.parametrize("name", sorted(LANDING))
def test_landing_upsert(spark, tmp_path, name):
    definition = LANDING[name]
    kinds = {f.name: f.dataType.simpleString() for f in definition.schema.fields}
    for n in (1, 2):
        row = tuple(value(k, 1 if c in definition.key else n) for c, k in kinds.items())
        sinks.upsert_landing(spark.createDataFrame([row], definition.schema), str(tmp_path), name)
    got = table(spark, tmp_path, name).collect()
    assert len(got) == 1
    updated = set(definition.updated_columns())
    assert {c for c in kinds if got[0][c] == value(kinds[c], 2) and c not in definition.key} == updated


def test_alerts(spark, frame, tmp_path):
    text = '{"timelaps":[{"domain_id":"01","timelaps_items":[{"phenomenon_id":1,"color_id":3,"begin_time":1700000000000,"end_time":1700003600000}]}]}'
    stamp = F.lit(AS_OF).cast("timestamp_ntz")
    documents = open_alert_documents(frame("document string", (text,))).withColumns({"extracted_at": stamp, "extraction_date": stamp.cast("date")})
    dictionaries = {
        "phenomena": frame("id string, name string", ("1", "vent")),
        "colors": frame("id string, name string, level int, hexaCode string", ("3", "orange", 3, "#ffb")),
        "departments": frame("code string, name string", ("01", "Ain")),
        "stores": frame("gie_name string, department_code string", ("s1", "01"), ("s2", "01"), ("s3", "02")),
    }
    for _ in range(2):
        ingest.ingest_alerts(documents, dictionaries, str(tmp_path), AS_OF)
    assert rows(table(spark, tmp_path, "alerts").select("department_name", "phenomenon_name", "color_name")) == [("Ain", "vent", "orange")]
    assert rows(table(spark, tmp_path, "store_alerts").select("gie_name", "alert_level")) == [("s1", "orange"), ("s2", "orange")]
    assert table(spark, tmp_path, "alert_metadata").count() == 2
    log = spark.read.parquet(f"{tmp_path}/{ingest.RUN_LOG}")
    assert rows(log.select("pipeline", "pass_rate").distinct()) == [("alerts", 1.0), ("store_alerts", 1.0)]
    with pytest.raises(QualityGateError):
        ingest.ingest_alerts(documents.where("false"), dictionaries, str(tmp_path), AS_OF)


def test_store_alerts_are_made_once(spark, frame, tmp_path, monkeypatch):
    """Gate and keys are settled before the join; what lands, and the rate, are those of all joined rows."""
    day, at = date(2024, 1, 7), datetime(2024, 1, 7, 1)
    later, day2 = datetime(2024, 1, 7, 2), date(2024, 1, 8)
    alerts = frame(
        "department_code string, department_name string, phenomenon_id int, phenomenon_name string, begin_time timestamp_ntz, "
        "end_time timestamp_ntz, color_id int, color_name string, color_level int, color_hex string, extracted_at timestamp_ntz, extraction_date date",
        *[(code, f"D{code}", n, wind, begin, None, n, color, n, "#f", seen, on)
          for code in ("1", "2", "3", None) for n, (wind, begin, color, seen, on) in enumerate([
              ("vent", at, "vert", at, day), ("vent", at, "rouge", later, day), ("vent", at, "jaune", later, day), ("neige", at, "vert", at, day2),
              ("vent", None, "vert", at, day), ("vent", None, "vert", later, day), ("vent", None, "vert", at, day), (None, at, "vert", at, day)])],
    )
    pairs = [("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), ("c", "2"), ("c", "1"), ("d", "3"), ("e", "9"), ("f", None), (None, "1")]
    stores = frame("gie_name string, department_code string", *pairs)
    made = []
    monkeypatch.setattr(ingest, "staged", lambda df, label: made.append(df.columns) or sinks.staged(df, label))
    stamp = F.lit(AS_OF).cast("timestamp_ntz")
    for per_task in (ingest.PER_TASK, 2):
        monkeypatch.setattr(ingest, "PER_TASK", per_task)
        base, plain = f"{tmp_path}/{per_task}", f"{tmp_path}/plain{per_task}"
        for _ in range(2):
            ingest.land_store_alerts(alerts, stores, base, AS_OF, minimum=0.5)
            by_store = ingest.alerts_by_store(alerts, stores)
            valid = by_store.where("gie_name IS NOT NULL AND phenomenon_name IS NOT NULL")
            sinks.upsert_landing(valid, plain, "store_alerts", created_at=stamp)
            assert rows(sinks.read_landing(spark, base, "store_alerts")) == rows(sinks.read_landing(spark, plain, "store_alerts"))
        log = spark.read.parquet(f"{base}/{ingest.RUN_LOG}").select("total_records", "valid_records", "error_records").distinct()
        assert rows(log) == [(by_store.count(), valid.count(), by_store.count() - valid.count())]
    assert made and not [columns for columns in made if {"gie_name", "phenomenon_name"} <= {*columns}]
    with pytest.raises(QualityGateError):
        ingest.land_store_alerts(alerts, stores.where("department_code = '9'"), base, AS_OF)


def test_store_alerts_are_written_by_group(spark, frame, tmp_path, monkeypatch):
    """Files are counted by the rows that land, hold the stores of few departments, and none far more rows than its share."""
    days, at = (date(2024, 1, 7), date(2024, 1, 8)), datetime(2024, 1, 7, 1)
    alerts = frame(
        "department_code string, department_name string, phenomenon_id int, phenomenon_name string, begin_time timestamp_ntz, "
        "end_time timestamp_ntz, color_id int, color_name string, color_level int, color_hex string, extracted_at timestamp_ntz, extraction_date date",
        *[(code, f"D{code}", 1, "vent", at + timedelta(hours=n) if n else None, None, 1, "vert", 1, "#f", at + timedelta(minutes=again if n else 0), day)
          for code in "1234" for day in days for n in range(30) for again in range(20)],
    )
    stores = frame("gie_name string, department_code string", *[(f"s{code}-{n}", code) for code, count in (("1", 60), ("2", 4), ("3", 4)) for n in range(count)])
    monkeypatch.setattr(ingest, "PER_TASK", 200)
    ingest.land_store_alerts(alerts, stores, str(tmp_path), AS_OF)
    plain, stamp = f"{tmp_path}/plain", F.lit(AS_OF).cast("timestamp_ntz")
    sinks.upsert_landing(ingest.alerts_by_store(alerts, stores), plain, "store_alerts", created_at=stamp)
    landed = rows(sinks.read_landing(spark, str(tmp_path), "store_alerts"))
    assert landed == rows(sinks.read_landing(spark, plain, "store_alerts"))
    files = [parquet.read_table(path).column("department_code").to_pylist() for path in tmp_path.glob("store_alerts/*/*.parquet")]
    assert len(files) <= 2 * (1 + len(landed) // 200)
    assert max(map(len, files)) <= 3 * 200
    assert all(sum(a != b for a, b in zip(codes, codes[1:])) <= 2 for codes in files)


def test_risks(spark, frame, tmp_path):
    text = '{"01001":{"commune":{"libelle":"A","codePostal":"01400"},"risquesNaturels":{"seisme":{"present":true,"libelleStatutCommune":"faible"}}}}'
    stamp = F.lit(AS_OF).cast("timestamp_ntz")
    documents = frame("document string", (text,)).withColumns({"extracted_at": stamp, "extraction_date": stamp.cast("date")})
    dictionaries = {
        "departments": frame("code string, name string, region string", ("01", "Ain", "ARA")),
        "risk_types": frame("key string, label string", ("seisme", "Quake")),
        "stores": frame("gie_name string, insee_code string, commune string, postal_code string", ("s1", "01001", None, None), ("s2", "99", "B", "33000")),
    }
    ingest.ingest_risks(documents, dictionaries, str(tmp_path), AS_OF)
    assert rows(table(spark, tmp_path, "commune_profiles").select("commune", "region", "total_risks", "seisme_severity")) == [("A", "ARA", 1, 1)]
    assert rows(table(spark, tmp_path, "risk_details").select("risk_libelle", "severity_label")) == [("Quake", "faible")]
    got = table(spark, tmp_path, "store_risks").select("gie_name", "commune", "department_code", "region", "total_risks")
    assert rows(got) == [("s1", "A", "01", "ARA", 1), ("s2", "B", "33", "inconnu", 0)]


def test_books_and_quotes(spark, frame, tmp_path):
    item = '<article class="product_pod"><h3><a href="{}" title="t">t</a></h3></article>'
    numbers = list(range(30))
    listings = frame("page_no int, url string, html string", (1, "l", "".join(item.format(n) for n in numbers)))
    price = {n: "900.5" if n == 7 else "51.77" for n in numbers}
    details = frame(
        "url string, html string",
        *[(f"https://books.toscrape.com/catalogue/{n}", DETAIL.replace("a897", f"upc{n}").replace("51.77", price[n])) for n in numbers],
    )
    ingest.ingest_books(listings, details, str(tmp_path), AS_OF)
    assert table(spark, tmp_path, "books").count() == 29
    assert rows(spark.read.parquet(f"{tmp_path}/anomalies/books").select("upc", "price")) == [("upc7", 900.5)]
    quote = '<div class="quote"><span class="text">“q”</span><small class="author">Ann B.</small></div>'
    ingest.ingest_quotes(
        frame("page_no int, url string, html string", (1, "u", quote)), frame("slug string, html string", ("Ann-B", "<h3 class=author-title>Ann</h3>")),
        str(tmp_path), AS_OF,
    )
    joined = table(spark, tmp_path, "quotes").join(table(spark, tmp_path, "authors"), F.col("author_slug") == F.col("slug"))
    assert rows(joined.select("text", "name")) == [("q", "Ann")]


def test_source_health(spark, frame, tmp_path):
    frame("extracted_at timestamp_ntz", (datetime(2024, 1, 7, 2),)).write.parquet(f"{tmp_path}/a")
    catalog = Catalog(spark, {"ta": Dataset(f"{tmp_path}/a"), "tb": Dataset(f"{tmp_path}/missing")})
    definitions = [("a", "ta", 3600, "no a"), ("b", "tb", 3600, "no b"), ("c", "tc", 60, "no c")]
    metrics = frame(LANDING["run_metrics"].ddl, ("a", "d", date(2024, 1, 6), 20, 20, 0, 1.0, None, None))
    calls = frame("source string, ts timestamp_ntz, ok boolean", ("a", datetime(2024, 1, 7, 2), True), ("b", datetime(2024, 1, 7, 2), False))
    scores = source_health(spark, catalog, metrics, calls, str(tmp_path), AS_OF, definitions=definitions)
    assert {r["source"]: r["grade"] for r in scores.collect()} == {"a": "A", "b": "B", "c": "B"}
    states = spark.read.parquet(f"{tmp_path}/source_freshness")
    assert rows(states.select("source", "state")) == [("a", "live"), ("b", "unavailable"), ("c", "unavailable")]
    for name, definition in MONITORING.items():
        assert set(definition.columns) <= set(spark.read.parquet(f"{tmp_path}/{name}").columns)
