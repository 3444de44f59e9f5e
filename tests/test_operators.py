import random
from datetime import date, datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lakeweir.operators import anomaly, breaker, density, forecast, health, normalize, snapshot
from lakeweir.operators.upsert import DuplicateKeyError, upsert
from lakeweir.sources.schemas import ALERT_DOCUMENT, LANDING
from tests.conftest import rows

STAMP = datetime(2024, 1, 1)


def test_latest_snapshot_and_high_water(frame):
    df = frame("k int, d date", (1, date(2024, 1, 1)), (2, date(2024, 1, 2)), (3, date(2024, 1, 3)), (4, None))
    assert rows(snapshot.latest_snapshot(df, "d").select("k")) == [(3,)]
    assert snapshot.latest_snapshot(df.where("k > 9"), "d").count() == 0
    held = df.where("k = 2")
    assert rows(snapshot.above_high_water(df, "d", held).select("k")) == [(3,)]
    assert rows(snapshot.above_high_water(df, "d", held, 1).select("k")) == [(2,), (3,)]
    assert snapshot.above_high_water(df, "d", held.where("k = 9")).count() == 4


def test_keep_first_with_hot_key(spark):
    df = spark.range(0, 9000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        (F.lit(9000) - F.col("id")).alias("seq"),
        F.col("id").alias("v"),
    )
    got = snapshot.keep_first(df, ["k"], ["seq"])
    assert got.columns == ["k", "seq", "v"]
    assert got.count() == 6001
    assert got.where("k = 'hot'").first()["v"] == 8997
    assert snapshot.keep_latest(df, ["k"], ["seq"]).where("k = 'hot'").first()["v"] == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


UPSERT = "k int, d int, a string, b string, extracted_at int"


def test_upsert_rules(frame):
    target = frame(UPSERT, (1, 1, "x", "y", 1), (2, 1, "x", "y", 1), (None, 1, "n", "n", 1))
    batch = frame(UPSERT, (2, 1, None, "B", 2), (2, 1, "old", "old", 1), (3, 1, "new", "new", 2), (None, 1, "n", "n", 2))
    kept = [(1, 1, "x", "y", 1), (3, 1, "new", "new", 2), (None, 1, "n", "n", 1), (None, 1, "n", "n", 2)]

    def result(*updates):
        return rows(upsert(target, batch, ["k", "d"], *updates))

    assert result() == sorted([*kept, (2, 1, None, "B", 2)], key=repr)
    assert result(["b"]) == sorted([*kept, (2, 1, "x", "B", 1)], key=repr)
    assert result([]) == sorted([*kept, (2, 1, "x", "y", 1)], key=repr)
    with pytest.raises(DuplicateKeyError):
        upsert(target, batch, ["k", "d"], strict=True)
    with pytest.raises(ValueError):
        upsert(target, batch, ["k"], ["zzz"])


def test_upsert_twice_is_once(frame):
    target = frame(UPSERT, (1, 1, "x", "y", 1))
    batch = frame(UPSERT, (1, 1, "X", "Y", 2), (5, 1, "p", "q", 2))
    once = upsert(target, batch, ["k", "d"])
    assert rows(upsert(once, batch, ["k", "d"])) == rows(once)


def test_alert_rows(frame, spark):
    text = """{"timelaps": [
      {"domain_id": "2A", "timelaps_items": [
        {"phenomenon_id": 3, "color_id": "2", "begin_time": 1700000000000, "end_time": "1700003600000"},
        {"phenomenon_id": "q", "color_id": 9, "begin_time": "1700000000000", "end_time": ""}]},
      {"domain_id": "77"}, {"timelaps_items": [{"phenomenon_id": "4"}]}]}"""
    documents = frame("document string", (text,)).select(
        F.from_json("document", ALERT_DOCUMENT)["timelaps"].alias("timelaps"),
        F.lit(STAMP).cast("timestamp_ntz").alias("extracted_at"),
        F.lit(date(2024, 1, 1)).alias("extraction_date"),
    )
    got = normalize.alert_rows(
        documents,
        frame("id string, name string", ("3", "storm")),
        frame("id string, name string, level int, hexaCode string", ("2", "jaune", 2, "#ff0")),
        frame("code string, name string", ("2A", "Corse-du-Sud")),
    )
    assert got.columns == LANDING["alerts"].columns
    assert [f.dataType.simpleString() for f in got.schema.fields] == [f.dataType.simpleString() for f in LANDING["alerts"].schema.fields]
    short = got.select("department_code", "department_name", "phenomenon_id", "phenomenon_name", "begin_time", "end_time", "color_id", "color_name", "color_level", "color_hex")
    assert rows(short) == sorted(
        [
            ("2A", "Corse-du-Sud", 3, "storm", datetime(2023, 11, 14, 22, 13, 20), datetime(2023, 11, 14, 23, 13, 20), 2, "jaune", 2, "#ff0"),
            ("2A", "Corse-du-Sud", 0, "autre", None, None, 9, "vert", 1, "#31a354"),
            ("", "inconnu", 4, "autre", None, None, 0, "vert", 1, "#31a354"),
        ],
        key=repr,
    )


REPORT = """{"75056": {"commune": {"libelle": "Paris", "codePostal": "75001"},
  "risquesNaturels": {"seisme": {"present": true, "libelle": "Séisme", "libelleStatutCommune": "Risque Important"},
     "note": "text", "radon": {"present": true, "libelleStatutCommune": "", "libelleStatutAdresse": "faible"},
     "retraitGonflementArgile": {"libelleStatutAdresse": "moyen"}, "inondation": {"present": null}},
  "risquesTechnologiques": {"icpe": {"present": true, "libelleStatutCommune": "inconnu"}, "seisme": {"present": false, "libelleStatutCommune": "faible"}}},
 "2A004": {"commune": null, "risquesNaturels": null}}"""


def test_reports(frame):
    parsed = normalize.parse_reports(normalize.split_reports(frame("document string", (REPORT,))))
    departments = frame("code string, name string, region string", ("75", "Paris", "IdF"))
    profiles = {r["insee_code"]: r.asDict() for r in normalize.profile_rows(parsed, departments).collect()}
    paris, corse = profiles["75056"], profiles["2A004"]
    want = dict(
        commune="Paris", code_postal="75001", department_code="75", department_name="Paris", region="IdF", naturels_count=2,
        technologiques_count=1, total_risks=3, max_severity_naturels=3, max_severity_technologiques=0,
        seisme_present=False, seisme_severity=1, radon_present=True, radon_severity=1, rga_present=False, rga_severity=2,
        rga_statut="moyen", inondation_present=False, icpe_present=True, nucleaire_present=False,
    )
    assert {k: paris[k] for k in want} == want
    assert (corse["total_risks"], corse["department_code"], corse["department_name"], corse["rga_statut"]) == (0, "", "inconnu", "")
    details = normalize.detail_rows(parsed, frame("key string, label string", ("seisme", "Quake")))
    labels = {(r["risk_category"], r["risk_key"]): (r["risk_libelle"], r["severity_label"]) for r in details.collect()}
    assert labels[("naturel", "seisme")] == ("Quake", "eleve")
    assert labels[("naturel", "radon")] == ("radon", "faible")
    assert ("naturel", "note") not in labels and len(labels) == 6


def reference_anomalies(values, name, limit):
    s = pd.to_numeric(pd.Series(values), errors="coerce")
    mean, std = s.mean(), s.std()
    if pd.isna(std) or std == 0:
        return [None] * len(values)
    z = (s - mean) / std
    return [f"{name} has outlier Z-score ({v:.2f} > {limit})" if abs(v) > limit else None for v in z]


@pytest.mark.parametrize("values", [[1.0] * 30 + [50.0], [1.0] * 40 + [-90.0, None], [2.0] * 5, [7.0], [None, None]])
def test_anomalies(frame, values):
    df = frame("i int, v double", *[(i, v) for i, v in enumerate(values)])
    got = [r["anomaly_reasons"] for r in anomaly.detect_anomalies(df, ["v", "missing"]).orderBy("i").collect()]
    assert got == [[] if w is None else [w] for w in reference_anomalies(values, "v", 3.0)]


def test_anomalies_of_text_and_two_reasons(frame):
    df = frame("i int, v string, w int", *[(i, "1" if i % 2 else "x", 3 + i % 2) for i in range(50)], (50, "-80", 900))
    flagged = anomaly.detect_anomalies(df, ["v", "w"])
    hit = flagged.where("is_anomaly").collect()
    assert [r["i"] for r in hit] == [50] and len(hit[0]["anomaly_reasons"]) == 2
    bad, clean = anomaly.split_anomalies(flagged)
    assert bad.count() + clean.count() == df.count() and clean.columns == df.columns


def test_forecast_against_polyfit(frame):
    start, rng = date(2024, 1, 1), random.Random(3)
    data = {"a": [(start + timedelta(days=2 * i), rng.random() * 9 + i) for i in range(9) for _ in range(2)],
            "falling": [(start + timedelta(days=i), 3.0 - i) for i in range(4)],
            "short": [(start, 1.0), (start + timedelta(days=1), 2.0)]}
    df = frame("s string, extraction_date date, price double", *[(s, d, p) for s, ps in data.items() for d, p in ps])
    got = forecast.forecast_prices(df, ["s"], days=7).orderBy("s", "extraction_date").collect()
    for s, ps in data.items():
        daily = pd.DataFrame(ps, columns=["d", "p"]).groupby("d")["p"].mean()
        mine = [r for r in got if r["s"] == s]
        history = [r for r in mine if not r["is_forecast"]]
        assert [r["price"] for r in history] == pytest.approx(list(daily))
        assert all(r["price"] == r["forecasted_price"] for r in history)
        future = [r for r in mine if r["is_forecast"]]
        if len(daily) < 3:
            assert not future
            continue
        slope, intercept = np.polyfit(np.arange(len(daily)), daily.values, 1)
        want = np.clip(slope * np.arange(len(daily), len(daily) + 7) + intercept, 0.01, None)
        assert [r["forecasted_price"] for r in future] == pytest.approx(list(want))
        assert [r["extraction_date"] for r in future] == [daily.index.max() + timedelta(days=i) for i in range(1, 8)]
        assert all(r["price"] is None for r in future)


def test_freshness_limits(frame, spark):
    as_of = datetime(2024, 1, 10)
    definitions = health.source_definitions(spark, [(f"s{h}", "t", 3600, "gap") for h in (1, 2, 3, 4, 5)] + [("none", "t", 60, "gap")])
    seen = frame(
        "source string, last_extraction timestamp_ntz",
        *[(f"s{h}", as_of - timedelta(hours=h)) for h in (1, 2, 3, 4, 5)], ("extra", as_of),
    )
    got = {r["source"]: r for r in health.assess_freshness(seen, definitions, F.lit(as_of).cast("timestamp_ntz")).collect()}
    assert [got[f"s{h}"]["state"] for h in (1, 2, 3, 4, 5)] == ["live", "delayed", "stale", "stale", "critical"]
    assert got["s1"]["gap_description"] is None and got["s2"]["gap_description"] == "gap"
    assert (got["none"]["state"], got["none"]["age_seconds"], got["none"]["gap_description"]) == ("unavailable", None, "gap")
    assert got["extra"]["gap_description"] == "Source 'extra' not configured"
    assert len(health.SOURCE_DEFINITIONS) == 8


def test_health_and_scores(frame):
    freshness = frame("source string, age_seconds bigint, interval_seconds bigint", ("a", 3600, 3600), ("b", None, None), ("c", 99999, 3600))
    metrics = frame("source string, items_extracted bigint, errors bigint", ("a", 5, 5), ("c", 0, 3))
    breakers = frame("source string, state string", ("a", "open"), ("b", "closed"))
    inputs = health.health_inputs(freshness, metrics, breakers)
    got = {r["source"]: tuple(r)[1:] for r in inputs.collect()}
    assert got == {"a": (0.375, 0.5, 0.5, 1.0), "b": (1.0, 0.5, 0.0, 1.0), "c": (0.0, 0.5, 3.0, 1.0)}
    strict = health.health_inputs(freshness, metrics, breakers, strict=True)
    assert strict.where("source = 'b'").first()["freshness_ratio"] == 0.0
    scores = {r["source"]: (r["score"], r["grade"]) for r in health.quality_scores(inputs).collect()}
    assert scores == {"a": (56.3, "D"), "b": (87.5, "B"), "c": (32.5, "F")}
    edges = frame("source string, freshness_ratio double, volume_ratio double, error_rate double, schema_compliance double",
                  ("hi", 9.0, 1.0, -1.0, 0.5), ("lo", -4.0, 0.0, 2.0, 0.0))
    scores = {r["source"]: (r["score"], r["grade"]) for r in health.quality_scores(edges).collect()}
    assert scores == {"hi": (90.0, "A"), "lo": (0.0, "F")}


def test_gate(frame):
    today = F.lit("2024-01-05").cast("date")
    good = frame("d date", (date(2024, 1, 3),))
    assert health.enforce_mart_gate(health.mart_gate({"a": (good, "d")}, today)) == {"a": 1}
    frames = {"a": (good, "d"), "b": (good.where("false"), "d"), "c": (frame("d date", (None,)), "d"), "e": (frame("d date", (date(2024, 1, 2),)), "d")}
    with pytest.raises(health.MartGateError) as error:
        health.enforce_mart_gate(health.mart_gate(frames, today))
    assert str(error.value) == "b: empty; c: undated; e: stale 3d"


def test_track_run(spark, frame):
    seen = []
    with health.track_run(spark, "s", "d", "2024-01-01", lambda df: seen.append(df.first()), min_records=2) as run:
        df = run.watch(spark.range(5).repartition(3), "items_extracted")
        run.watch(df.where("id > 1"), "items_loaded").write.format("noop").mode("overwrite").save()
    assert (seen[0]["items_extracted"], seen[0]["items_loaded"], seen[0]["errors"]) == (5, 3, 0)
    with pytest.raises(health.TooFewRecordsError):
        with health.track_run(spark, "s", "d", "2024-01-01", lambda df: seen.append(df.first()), min_records=2) as run:
            run.items_loaded = 1
    with pytest.raises(KeyError):
        with health.track_run(spark, "s", "d", "2024-01-01", lambda df: seen.append(df.first()), min_records=2) as run:
            raise KeyError("x")
    assert [r["errors"] for r in seen] == [0, 0, 1]


def test_density(frame):
    df = frame("a int, note int, t string, f double", *[(0, 0, " - " if i else "x", 0.5) for i in range(10)])
    got = {r["column"]: (r["null_rate"], r["sparse"]) for r in density.column_density(df).collect()}
    assert got == {"a": (1.0, True), "note": (1.0, False), "t": (0.9, False), "f": (0.0, False)}
    status = lambda d: density.density_status(density.column_density(d), "n").first()["status"]
    assert status(df) == "SPARSE_COLUMNS"
    assert status(df.limit(9)) == "OK"
    assert status(df.where("false")) == "EMPTY_OK"
    assert status(frame("n int", (0,))) == "EMPTY_KPI"


def loop_breaker(calls, as_of, limit, cooldown):
    """The rules one call after the other."""
    state = {}
    for source, at, ok in calls:
        s = state.setdefault(source, {"state": "closed", "n": 0, "last": None, "trips": 0})
        if s["state"] == "open" and (at - s["last"]).total_seconds() >= cooldown:
            s["state"] = "half_open"
        if s["state"] == "open":
            continue
        if ok:
            s["state"], s["n"] = "closed", 0
        else:
            s["n"], s["last"] = s["n"] + 1, at
            if s["n"] >= limit:
                s["state"], s["trips"] = "open", s["trips"] + 1
    for s in state.values():
        if s["state"] == "open" and (as_of - s["last"]).total_seconds() >= cooldown:
            s["state"] = "half_open"
    return sorted((k, s["state"], s["n"], s["trips"], s["last"]) for k, s in state.items())


@pytest.mark.parametrize("seed, limit, failing, gap", [(1, 2, 0.7, 2.0), (2, 1, 0.5, 0.6), (3, 3, 0.9, 1.0), (4, 2, 1.0, 0.9), (5, 2, 0.02, 1.0)])
def test_breaker_against_loop(frame, seed, limit, failing, gap):
    rng, calls, cooldown = random.Random(seed), [], 5.0
    for source in ("hot", "warm", "rare"):
        at = datetime(2024, 1, 1)
        for _ in range({"hot": 1500, "warm": 300, "rare": 3}[source]):
            at += timedelta(seconds=rng.choice([0.0, gap, gap * 3 * rng.random(), 40.0 if rng.random() < 0.02 else gap]))
            calls.append((source, at, rng.random() >= failing))
    as_of = max(c[1] for c in calls) + timedelta(seconds=2)
    df = frame("n int, source string, ts timestamp_ntz, ok boolean", *[(i, *c) for i, c in enumerate(calls)])
    got = breaker.breaker_states(
        df.repartition(5), F.lit(as_of).cast("timestamp_ntz"), order=["n"], max_failures=limit, cooldown=cooldown, chunk_seconds=60
    )
    want = [(a, b, c, d, e) for a, b, c, d, e in loop_breaker(calls, as_of, limit, cooldown)]
    assert rows(got) == sorted(want, key=repr)
    # The same history in two halves, the second going on from the first.
    order = dict(order=["n"], max_failures=limit, cooldown=cooldown, chunk_seconds=3)
    half = len(calls) // 2
    middle = F.lit(as_of - timedelta(minutes=5)).cast("timestamp_ntz")
    ordered = df.orderBy("ts", "n").limit(half)
    rest = df.join(ordered.select("n"), "n", "left_anti")
    first = breaker.breaker_states(ordered, middle, **order)
    second = breaker.breaker_states(rest, F.lit(as_of).cast("timestamp_ntz"), initial=first, **order)
    assert rows(second) == sorted(want, key=repr)
