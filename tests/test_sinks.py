import glob
import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeweir.plans import refresh as refresh_plan
from lakeweir.plans import staging
from lakeweir.plans.incremental import merge_new_alerts, refresh_alert_facts
from lakeweir.plans.marts import fct_alerts
from lakeweir.session import scratch
from lakeweir.sources import documents, sinks, versions
from lakeweir.sources.catalog import Catalog, Dataset
from lakeweir.sources.schemas import LANDING, MONITORING
from lakeweir.streaming import stream_files, upsert_stream
from tests.conftest import SMALL, rows
from workload import tables
from workload.tables import Tables


def test_catalog_layouts(spark, frame, tmp_path):
    df = frame("code string, n int, d date", ("01", 1, date(2024, 1, 1)), ("2A", 2, date(2024, 1, 2)))
    sinks.replace_partitions(df, f"{tmp_path}/parts", "d")
    sinks.replace_partitions(df, f"{tmp_path}/codes", "code")
    df.createOrReplaceTempView("coded")
    files = df.drop("d").schema
    catalog = Catalog(
        spark,
        {
            "parts": Dataset(f"{tmp_path}/parts", "partitioned", files, df.schema["d"]),
            "codes": Dataset(f"{tmp_path}/codes", "partitioned", df.drop("code").schema, df.schema["code"]),
            "view": Dataset("coded", "table"),
        },
    )
    for name in ("parts", "codes", "view"):
        assert rows(catalog[name].select("code", "n", "d")) == rows(df)
    pruned = catalog["parts"].where("d = DATE '2024-01-02'")
    assert "PartitionFilters: [isnotnull(d" in pruned._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(KeyError):
        catalog["other"]


def test_snapshot_reads_itself(spark, frame, tmp_path):
    path = f"{tmp_path}/s"
    sinks.replace_snapshot(frame("n int", (1,), (2,)), path)
    sinks.replace_snapshot(spark.read.parquet(path).where("n > 1"), path)
    assert rows(spark.read.parquet(path)) == [(2,)]
    assert [p.split("/")[-1] for p in glob.glob(f"{tmp_path}/*")] == ["s"]


def test_partition_upsert_leaves_others_alone(spark, frame, tmp_path):
    ddl, path = "k int, d date, v string, extracted_at int", f"{tmp_path}/t"
    first = frame(ddl, (1, date(2024, 1, 1), "a", 1), (1, date(2024, 1, 2), "a", 1))
    schema = first.schema
    sinks.upsert_table(first, path, schema, ["k", "d"], partition_by="d")
    untouched = glob.glob(f"{path}/d=2024-01-01/*.parquet")
    batch = frame(ddl, (1, date(2024, 1, 2), "b", 2), (2, date(2024, 1, 2), "c", 2))
    for _ in range(2):  # a rerun changes nothing
        sinks.upsert_table(batch, path, schema, ["k", "d"], partition_by="d")
        assert rows(spark.read.schema(schema).parquet(path).select(*schema.names)) == [(1, date(2024, 1, 1), "a", 1), (1, date(2024, 1, 2), "b", 2), (2, date(2024, 1, 2), "c", 2)]
    assert glob.glob(f"{path}/d=2024-01-01/*.parquet") == untouched
    with pytest.raises(ValueError):
        sinks.upsert_table(batch, path, schema, ["k"], partition_by="d")


def test_whole_table_upsert(spark, frame, tmp_path):
    table = LANDING["alert_metadata"]
    path = f"{tmp_path}/meta"
    for level in (1, 2):
        sinks.upsert_table(frame(table.ddl, ("color", "1", "vert", level, "#0")), path, table.schema, table.key, newest_by=None)
    assert rows(spark.read.parquet(path)) == [("color", "1", "vert", 2, "#0")]


def test_materialize(spark, frame, tmp_path):
    df = frame("k int, v string, extracted_at int", (1, "a", 1))
    sinks.materialize(df, "m_view")
    for text in ("a", "b"):
        sinks.materialize(df.withColumn("v", F.lit(text)), "m_inc", "incremental", path=f"{tmp_path}/m", keys=["k"])
    assert rows(spark.table("m_view")) == [(1, "a", 1)] and rows(spark.table("m_inc")) == [(1, "b", 1)]
    with pytest.raises(ValueError):
        sinks.materialize(df, "x", "cube")


def test_documents(spark, frame, tmp_path):
    df = frame("n int, at string", (1, "2024-03-04T10:00"), (2, "bad"))
    sinks.write_documents(df, str(tmp_path), "retail", "books", "at", "2024-12-31")
    found = sorted(glob.glob(f"{tmp_path}/domain=retail/source=books/year=2024/*/*/*.json.gz"))
    assert [tuple(f.split("/")[-3:-1]) for f in found] == [("month=03", "day=04"), ("month=12", "day=31")]
    assert json.loads(gzip.open(found[0]).read()) == {"n": 1, "at": "2024-03-04T10:00"}
    (tmp_path / "doc.json").write_text('{"a":\n 1}')
    assert rows(documents.read_documents(spark, f"{tmp_path}/doc.json", "a int")) == [(1,)]
    assert documents.read_dictionary(spark, f"{tmp_path}/none.json", "a int").count() == 0
    (tmp_path / "broken.json").write_text('{"a":')
    assert documents.read_dictionary(spark, f"{tmp_path}/broken.json", "a int").count() == 0
    (tmp_path / "page.html").write_text("<p>1\n2</p>")
    assert documents.read_pages(spark, f"{tmp_path}/page.html").first()["html"] == "<p>1\n2</p>"


def test_quarantine_and_log(spark, frame, tmp_path):
    df = frame("n int, is_anomaly boolean, anomaly_reasons array<string>", (1, False, []), (2, True, ["x"]))
    sinks.split_quarantine(df, f"{tmp_path}/clean", f"{tmp_path}/bad")
    assert spark.read.parquet(f"{tmp_path}/clean").columns == ["n"]
    assert spark.read.parquet(f"{tmp_path}/bad").first()["anomaly_reasons"] == ["x"]
    for i in range(3):
        sinks.append_log(frame("source string", (f"s{i}",)), f"{tmp_path}/log", "checked_at", f"2024-01-0{i + 1} 00:00:00")
    log = spark.read.parquet(f"{tmp_path}/log")
    assert [r["source"] for r in sinks.latest_entries(log, "checked_at", 2).collect()] == ["s2", "s1"]


def test_table_definitions():
    assert len(LANDING) == 10 and len(MONITORING) == 3
    for table in LANDING.values():
        assert set(table.key) <= set(table.columns)
        assert set(table.updated_columns()) <= set(table.columns) - set(table.key)
    assert "region" not in LANDING["commune_profiles"].updated_columns()
    assert "phenomenon_name" not in LANDING["alerts"].updated_columns()


ALERT = "id int, " + LANDING["alerts"].ddl + ", created_at timestamp_ntz"


def alert(i, day, hex_="#1"):
    at = datetime(2024, 1, day, 5)
    return (i, "01", "Ain", i, "storm", at, at, 1, "vert", 1, hex_, at, at.date(), at)


def test_incremental(spark, frame, tmp_path):
    path = f"{tmp_path}/facts"
    refresh_alert_facts(spark, frame(ALERT, alert(1, 1), alert(1, 2)), path)
    again = frame(ALERT, alert(1, 1, "#x"), alert(1, 2, "#2"), alert(2, 2, "#2"), alert(1, 3, "#3"))

    def colors():
        return rows(spark.read.schema(fct_alerts(again).schema).parquet(path).select("phenomenon_id", "extraction_date", "color_hex"))

    refresh_alert_facts(spark, again, path)
    assert colors() == [(1, date(2024, 1, 1), "#1"), (1, date(2024, 1, 2), "#1"), (1, date(2024, 1, 3), "#3")]
    refresh_alert_facts(spark, again, path, lookback_days=2)
    assert colors() == [(1, date(2024, 1, 1), "#1"), (1, date(2024, 1, 2), "#2"), (1, date(2024, 1, 3), "#3"), (2, date(2024, 1, 2), "#2")]
    empty = fct_alerts(again).where("false")
    assert merge_new_alerts(empty, again).count() == 4


def test_stream_is_batch(spark, frame, tmp_path):
    first, second = frame(ALERT, alert(1, 1), alert(2, 1)), frame(ALERT, alert(1, 1, "#new"), alert(3, 2))
    keys, folder, out = list(LANDING["alerts"].key), f"{tmp_path}/in", f"{tmp_path}/out"
    stamped = second.withColumn("extracted_at", F.col("extracted_at") + F.make_dt_interval(hours=F.lit(1)))
    for df in (first, stamped):
        df.coalesce(1).write.mode("append").parquet(folder)
        upsert_stream(stream_files(spark, folder, first.schema), out, f"{tmp_path}/state", keys, partition_by="extraction_date").awaitTermination()
    got = spark.read.schema(first.schema).parquet(out)
    assert rows(got.select("id", "color_hex")) == [(1, "#new"), (2, "#1"), (3, "#1")]


def test_refresh_and_rerun(spark, tmp_path):
    tables = Tables(spark, SMALL)
    names = ("alerts", "commune_profiles", "risk_details", "books", "quotes", "authors")
    landing = {n: getattr(tables, n) for n in names}
    counts = [refresh_plan.refresh(spark, landing, str(tmp_path), "2024-02-01 00:00:00") for _ in range(2)]
    assert counts[0] == counts[1] and min(counts[0].values()) > 0
    facts = spark.read.parquet(f"{tmp_path}/marts/fct_alerts")
    assert facts.count() == facts.select("alert_key").distinct().count() == landing["alerts"].where("department_code is not null").count()


def test_scratch_is_deleted(spark, frame, tmp_path):
    kept = sinks.staged(frame("n int", (1,)), "kept")
    with scratch(spark):
        inner = sinks.staged(frame("n int", (2,)), "inner")
        path = inner.inputFiles()[0]
        kept.unionByName(inner).write.parquet(f"{tmp_path}/out")
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [(1,), (2,)] and rows(kept) == [(1,)]
    assert not glob.glob(path.removeprefix("file://"))


def _plans(spark, monkeypatch):
    """Plans of what is committed from now on."""
    seen, write = [], versions.write_files

    def noted(df, folder, by=(), gather=True):
        seen.append(df._jdf.queryExecution().optimizedPlan().toString() + (" gathered" if gather else ""))
        return write(df, folder, by, gather)

    monkeypatch.setattr(versions, "write_files", noted)
    return seen


def test_first_load_merges_only_repeated_keys(spark, frame, tmp_path, monkeypatch):
    """Rows alone with their key, repeated keys and NULLs in the key, loaded twice and in two ways, are stored alike."""
    ddl, path = "k string, v int, extracted_at timestamp_ntz, d date", str(tmp_path / "t")
    day, next_day, at = date(2024, 1, 1), date(2024, 1, 2), datetime(2024, 1, 1)
    batch = [("a", 1, at, day), ("b", 1, at, day), ("b", 2, at, day), (None, 3, at, day), (None, 3, at, day), ("a", None, at, next_day)]
    want = sorted([r for r in batch if r != ("b", 1, at, day)], key=repr)
    split = []

    def noted(batch, keys, parts=sinks._standing_alone):
        alone, rest = parts(batch, keys)
        split.append(alone and rows(alone.select("k", "v")))
        return alone, rest

    monkeypatch.setattr(sinks, "_standing_alone", noted)
    for limit in (100, 0):
        monkeypatch.setattr(sinks, "REPEATED_KEYS", limit)
        for reread in (True, False):
            path = str(tmp_path / f"t{limit}{reread}")
            for _ in range(2):
                sinks.upsert_table(frame(ddl, *batch), path, frame(ddl).schema, ["k", "d"], partition_by="d", reread=reread)
                assert rows(versions.read_table(spark, path, frame(ddl).schema)) == want
    assert split == 2 * [[("a", 1), ("a", None)]] + 2 * [None]
    # Of a batch for a day that the table has and one that it lacks, all rows are merged.
    more = [("a", 5, at, day), ("z", 6, at, date(2024, 1, 3))]
    sinks.upsert_table(frame(ddl, *more), path, frame(ddl).schema, ["k", "d"], partition_by="d")
    left = [*more, *[r for r in want if r != batch[0]]]
    assert rows(versions.read_table(spark, path, frame(ddl).schema)) == sorted(left, key=repr)
    assert len(split) == 4


def test_alert_facts_of_a_snapshot_are_not_written_twice(spark, tmp_path, monkeypatch):
    alerts, labels = staging.stg_alerts(Tables(spark, SMALL).alerts), []
    monkeypatch.setattr(sinks, "working_path", lambda s, label, path=sinks.working_path: labels.append(label) or path(s, label))
    schema = fct_alerts(alerts).schema
    for reread in (False, True):
        path = f"{tmp_path}/{reread}"
        refresh_alert_facts(spark, alerts.where("extraction_date <= DATE '2024-01-20'"), path, reread=reread)
        refresh_alert_facts(spark, alerts, path, reread=reread)
    assert rows(versions.read_table(spark, f"{tmp_path}/True", schema)) == rows(versions.read_table(spark, f"{tmp_path}/False", schema))
    assert labels.count("upsert") == 2


def test_few_values(frame, monkeypatch):
    monkeypatch.setattr(sinks, "FEW_PARTITIONS", 2)
    assert [sinks.few_values(frame("d int", *[(i % n,) for i in range(9)])) for n in (1, 2, 3)] == [True, True, False]


def test_details_are_dealt_out_before_they_are_summed(spark, monkeypatch):
    """No task keeps a map of the lines that it reads, and more lines go to more tasks."""
    want = None
    for limit, many in ((500_000, 10_000_000), (100, 0)):
        monkeypatch.setattr(tables, "LINES_PER_TASK", limit)
        monkeypatch.setattr(tables, "MANY_LINES", many)
        details = Tables(spark, SMALL).risk_details
        plan = details._jdf.queryExecution().executedPlan().toString()
        tasks = max(8, 1 + Tables(spark, SMALL).lineitem.count() // limit)
        assert f"{tasks}), REPARTITION_BY_NUM" in plan and "HashAggregate" not in plan[plan.index("REPARTITION_BY_NUM"):]
        assert want is None or rows(details) == want
        want = rows(details)


def test_few_partitions_are_not_gathered(spark, frame, tmp_path, monkeypatch):
    ddl, seen = "k string, d date", _plans(spark, monkeypatch)
    batch = [(str(i), date(2024, 1, 1 + i % 3)) for i in range(9)]
    for few in (3, 2):
        monkeypatch.setattr(sinks, "FEW_PARTITIONS", few)
        path = str(tmp_path / str(few))
        sinks.upsert_table(frame(ddl, *batch), path, frame(ddl).schema, ["k", "d"], partition_by="d", newest_by=None)
        assert rows(versions.read_table(spark, path, frame(ddl).schema)) == sorted(batch, key=repr)
    assert [plan.endswith("gathered") for plan in seen] == [False, True]
