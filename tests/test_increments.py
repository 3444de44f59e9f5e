"""Late rows, mergeable history and stacked tests against plain code."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakeweir.operators import checks
from lakeweir.operators.checks import CheckFailure, Reference, Test
from lakeweir.plans import history, marts
from lakeweir.plans.refresh import enforce_required
from lakeweir.sources import versions
from lakeweir.streaming import dedup_with_late_rows, late_counts, late_rows, stream_files
from tests.conftest import rows

EVENT = "k int, day date, at timestamp_ntz, v string"
DAY = datetime(2024, 1, 1)


class Stopped(Exception):
    pass


def plain(batches, delay):
    """Kept and late rows of batches in order."""
    mark, kept, late = None, {}, []
    for number, batch in enumerate(batches):
        for row in batch:
            at = row[2]
            if mark is not None and (at is None or at < mark):
                late.append((*row, None if at is None else (mark - at) // timedelta(microseconds=1), number))
                continue
            rank = (at is not None, at or DAY, row[3] is not None, row[3] or "")
            key = row[:2]
            if key not in kept or rank < kept[key][0]:
                kept[key] = (rank, row)
        times = [r[2] for r in batch if r[2] is not None]
        if times:
            mark = max(filter(None, (mark, max(times) - delay)))
    return [row for _, row in kept.values()], late


@pytest.mark.parametrize("stop", [None, "_create", "clean", "write_files"])
def test_late_rows_go_aside(spark, frame, tmp_path, monkeypatch, stop):
    dice = random.Random(7)
    batches = []
    for n in range(5):
        batch = []
        for _ in range(20):
            at = DAY + timedelta(hours=12 * n + dice.randint(-30, 11))
            batch.append((dice.randint(1, 4), at.date(), at, dice.choice([None, "a", "b"])))
        batch.append((dice.choice([None, 9]), None, None, "no time"))
        batches.append(batch)
    folder, path, late, state = (f"{tmp_path}/{n}" for n in ("in", "kept", "late", "state"))
    schema = frame(EVENT, *batches[0]).schema

    def run():
        query = dedup_with_late_rows(
            stream_files(spark, folder, schema, files_per_batch=1), path, late, state, ["k", "day"], "at", 6 * 3600, partition_by="day"
        )
        query.awaitTermination()

    for number, batch in enumerate(batches):
        frame(EVENT, *batch).coalesce(1).write.mode("append").parquet(folder)
        if stop and number == 3:
            calls, real = [], getattr(versions, stop)

            def fail(*args, **kwargs):
                calls.append(args)
                if len(calls) == 2:
                    raise Stopped("half way")
                return real(*args, **kwargs)

            with monkeypatch.context() as patch:
                patch.setattr(versions, stop, fail)
                with pytest.raises(Exception, match="half way"):
                    run()
        run()
    kept, aside = plain(batches, timedelta(hours=6))
    assert len(aside) > 10 and len(kept) > 10
    assert rows(versions.read_table(spark, path, schema)) == sorted(kept, key=repr)
    found = late_rows(spark, late, schema)
    assert rows(found.select("k", "day", "at", "v", "late_micros", "batch")) == sorted(aside, key=repr)
    counts = {}
    for row in aside:
        counts[row[5]] = counts.get(row[5], 0) + 1
    assert {r["batch"]: r["late_rows"] for r in late_counts(found).collect()} == counts


def test_no_late_rows(spark, frame, tmp_path):
    schema = frame(EVENT, (1, DAY.date(), DAY, "a")).schema
    assert late_rows(spark, f"{tmp_path}/none", schema).count() == 0


PROFILE = "insee_code string, extraction_date date, max_severity_naturels int, max_severity_technologiques int"


def test_history_merges_in_any_order(spark, frame, tmp_path):
    dice = random.Random(4)
    days = [date(2024, 1, d) for d in range(1, 9)]
    table = [(f"c{dice.randint(1, 9)}", dice.choice(days), dice.randint(0, 3), dice.choice([None, 1, 2])) for _ in range(60)]
    whole = frame(PROFILE, *table)
    want = rows(marts.extraction_history(whole))
    parts = [frame(PROFILE, *[r for r in table if r[1] == d]) for d in days if any(r[1] == d for r in table)]
    dice.shuffle(parts)
    state = history.history_of(parts[0])
    for part in [*parts[1:], parts[2]]:
        state = history.merged_history(state, history.history_of(part))
    assert rows(history.extraction_history(state)) == want
    # On files: day by day, the last one twice, then a day that was missing.
    path = f"{tmp_path}/state"
    for until in (days[3], days[5], days[5], days[7]):
        part = whole.where((F.col("extraction_date") <= F.lit(until)) & (F.col("extraction_date") != F.lit(days[1])))
        history.refresh_history(spark, part, path)
    assert rows(history.extraction_history(history.refresh_history(spark, whole, path))) != want
    filled = history.refresh_history(spark, whole, path, since="2024-01-02")
    assert rows(history.extraction_history(filled)) == want
    newest = {r["insee_code"]: r["latest"] for r in filled.collect()}
    for code, latest in newest.items():
        assert latest["extraction_date"] == max(r[1] for r in table if r[0] == code)
    assert history.refresh_history(spark, whole.where("false"), f"{tmp_path}/none").count() == 0


def test_model_tests(spark, frame):
    parent = frame("id int, name string", (1, "a"), (1, "b"), (2, None), (None, "c"))
    child = frame("p int, n double", (1, 1.0), (3, 9.0), (3, 2.0), (None, None))
    tests = {
        "parent": [Test("id", "unique"), Test("name", "not_null", severity="error")],
        "child": [Test("p", "unique"), Test("n", "accepted_range", low=0, high=5), Test("p", "unique", where="n < 5")],
        "empty": [Test("p", "unique"), Test("n", "not_null")],
    }
    models = {"parent": parent, "child": child, "empty": child.where("false")}
    got = checks.run_model_tests(models, tests, [Reference("child", "p", "parent", "id", "error"), Reference("parent", "id", "child", "p")])
    assert rows(got) == sorted([
        ("parent", "id", "unique", 1, "warn"), ("parent", "name", "not_null", 1, "error"), ("child", "p", "unique", 1, "warn"),
        ("child", "n", "accepted_range", 1, "warn"), ("child", "p", "unique", 0, "pass"), ("empty", "p", "unique", 0, "pass"),
        ("empty", "n", "not_null", 0, "pass"), ("child", "p", "relationship", 2, "error"), ("parent", "id", "relationship", 1, "warn"),
    ], key=repr)


def test_each_model_is_scanned_once(spark, frame, tmp_path):
    for name in ("a", "b"):
        frame("id int, n int", (1, 2)).write.parquet(f"{tmp_path}/{name}")
    models = {name: spark.read.parquet(f"{tmp_path}/{name}") for name in ("a", "b")}
    tests = {name: [Test("id", "unique"), Test("n", "unique"), Test("n", "not_null")] for name in models}
    plan = checks.run_model_tests(models, tests, [Reference("a", "n", "b", "n")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2


def test_required_columns(frame):
    good = frame("id int, upc string, title string, price double", (1, "u", "t", 1.0))
    enforce_required({"books": good})
    with pytest.raises(CheckFailure, match="books: price is required"):
        enforce_required({"books": good.drop("price")})
