"""Writes that stop between any two steps, and two writers of one table."""

import glob
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakeweir.operators.upsert import upsert
from lakeweir.plans.refresh import refresh
from lakeweir.operators.health import MartGateError
from lakeweir.sources import sinks, versions
from lakeweir.sources.catalog import Catalog, Dataset
from lakeweir.sources.schemas import LANDING
from lakeweir.streaming import stream_files, upsert_stream
from tests.conftest import SMALL, rows
from workload.tables import Tables


class Stopped(Exception):
    pass


DATED = "k int, d date, v string, extracted_at int"
ONE, TWO, THREE = (date(2024, 1, n) for n in (1, 2, 3))


def whole(frame, path, text, by=()):
    versions.commit(frame("k int, v string", (1, text), (2, text)), path, by)


def dated(frame, path, text, days):
    batch = frame(DATED, *[(k, day, text, 1 if text == "old" else 2) for day in days for k in (1, 2)])
    sinks.upsert_table(batch, path, batch.schema, ["k", "d"], partition_by="d")


STEPS = ["write_files", "publish", "finish", "clean", "_move", "remove", "_create"]


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("call", [0, 1])
@pytest.mark.parametrize("late", [False, True])
@pytest.mark.parametrize("kind", ["whole", "dated"])
def test_stops_between_any_two_steps(spark, frame, tmp_path, monkeypatch, step, call, late, kind):
    path = f"{tmp_path}/t"
    days = [ONE, TWO]

    def write(text):
        whole(frame, path, text) if kind == "whole" else dated(frame, path, text, days if text == "old" else [TWO, THREE])

    def seen():
        return rows(versions.read_table(spark, path).select("k", "v", *(["d"] if kind == "dated" else [])))

    def want(text):
        if kind == "whole":
            return [(1, text), (2, text)]
        last = [TWO, THREE] if text == "new" else [TWO]
        return sorted([(k, "old", ONE) for k in (1, 2)] + [(k, text, day) for k in (1, 2) for day in last], key=repr)

    write("old")
    assert seen() == want("old")
    calls, real = [], getattr(versions, step)

    def stop(*args, **kwargs):
        calls.append(args)
        if len(calls) - 1 != call:
            return real(*args, **kwargs)
        if late:
            real(*args, **kwargs)
        raise Stopped

    with monkeypatch.context() as patch:
        patch.setattr(versions, step, stop)
        try:
            write("new")
        except Stopped:
            pass
    # One of both, whole; and the same for a reader that comes back.
    state = seen()
    assert state in (want("old"), want("new"))
    assert seen() == state
    write("new")
    assert seen() == want("new")
    # At rest the table is plain Parquet.
    assert rows(spark.read.schema(versions.read_table(spark, path).schema).parquet(path).select("k", "v")) == sorted(r[:2] for r in seen())
    assert os.listdir(f"{path}/{versions.VERSIONS}") == []


def test_broken_commit_file_does_not_count(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    whole(frame, path, "old")
    for text in ("", '{"number": 2, "fol'):
        number = versions.state(spark, path)[1]
        versions._create(spark, f"{path}/{versions.COMMITS}/{number:010d}.json", text)
        assert rows(versions.read_table(spark, path)) == [(1, "old"), (2, "old")]
    whole(frame, path, "new")
    assert rows(versions.read_table(spark, path)) == [(1, "new"), (2, "new")]


def test_second_writer_of_one_version_fails(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    whole(frame, path, "old")
    base = versions.begin(spark, path)
    whole(frame, path, "first")
    with pytest.raises(versions.ConcurrentWriteError):
        versions.commit(frame("k int, v string", (9, "second")), path, base=base)
    assert rows(versions.read_table(spark, path)) == [(1, "first"), (2, "first")]
    whole(frame, path, "third")
    assert rows(versions.read_table(spark, path)) == [(1, "third"), (2, "third")]


def test_plain_folder_becomes_a_table(spark, frame, tmp_path):
    path = f"{tmp_path}/t"
    frame("k int, v string", (1, "plain"), (2, "plain")).write.parquet(path)
    assert rows(Catalog(spark, {"t": Dataset(path)})["t"]) == [(1, "plain"), (2, "plain")]
    versions.commit(versions.read_table(spark, path).where("k = 2"), path)
    assert rows(versions.read_table(spark, path)) == rows(spark.read.parquet(path)) == [(2, "plain")]


def test_two_partition_columns_and_odd_values(spark, frame, tmp_path):
    path, ddl = f"{tmp_path}/t", "a string, b string, n int"
    sinks.replace_partitions(frame(ddl, ("x", "1", 1), ("x", "2", 2), ("{*}", "a/b", 3), (None, "1", 4)), path, ["a", "b"])
    sinks.replace_partitions(frame(ddl, ("x", "2", 5), ("{*}", "c", 6)), path, ["a", "b"])
    got = versions.read_table(spark, path, frame(ddl, ("x", "1", 1)).schema)
    assert rows(got) == sorted([("x", "1", 1), ("x", "2", 5), ("{*}", "a/b", 3), (None, "1", 4), ("{*}", "c", 6)], key=repr)
    empty = f"{tmp_path}/e"
    sinks.replace_partitions(frame(ddl, ("x", "1", 1)).where("false"), empty, ["a", "b"])
    assert versions.read_table(spark, empty).columns == ["a", "b", "n"] and versions.read_table(spark, empty).count() == 0


KEYED = "a int, b string, v string, extracted_at int"


def merged(old, new, updates):
    """The plain form: one row per full key, the newest of the batch; rows with a NULL key by content."""
    out = {}
    loose = {}
    for side, part in ((0, old), (1, new)):
        counts = {}
        for row in part:
            if None in (row[0], row[1]):
                counts[row] = counts.get(row, 0) + 1
        for row, n in counts.items():
            loose[row] = max(loose.get(row, 0), n)
        best = {}
        for row in part:
            if None not in (row[0], row[1]):
                rank = ((row[3] is not None, row[3] or 0), (row[2] is not None, row[2] or ""))
                best[row[:2]] = max(best.get(row[:2], (rank, row)), (rank, row))
        for key, (_, row) in best.items():
            if key not in out:
                out[key] = row
            else:
                out[key] = tuple(row[i] if c in updates else out[key][i] for i, c in enumerate(("a", "b", "v", "extracted_at")))
    return [*out.values(), *[row for row, n in loose.items() for _ in range(n)]]


@pytest.mark.parametrize("updates", [["v", "extracted_at"], ["v"], []])
def test_merge_reads_once_and_reruns(spark, frame, updates):
    import random

    dice = random.Random(len(updates))

    def some(n):
        return [
            (dice.choice([None, 1, 2, 3]), dice.choice([None, "x", "y"]), dice.choice([None, "p", "q"]), dice.choice([None, 1, 2]))
            for _ in range(n)
        ]

    old = merged(some(30), [], [])
    new = some(40)
    target, batch = frame(KEYED, *old), frame(KEYED, *new)
    once = upsert(target, batch, ["a", "b"], updates)
    want = sorted(merged(old, new, updates), key=repr)
    assert rows(once) == want
    again = frame(KEYED, *[tuple(r) for r in once.collect()])
    assert rows(upsert(again, batch, ["a", "b"], updates)) == want


def test_merge_plan_scans_each_side_once(spark, frame, tmp_path):
    for name in ("old", "new"):
        frame(KEYED, (1, "x", "p", 1)).write.parquet(f"{tmp_path}/{name}")
    old, new = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("old", "new"))
    plan = upsert(old, new, ["a", "b"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan


def test_a_phenomenon_keeps_level_and_color(spark, frame, tmp_path):
    ddl = LANDING["alert_metadata"].ddl
    sinks.upsert_landing(frame(ddl, ("phenomenon", "1", "wind", 3, "#1"), ("color", "1", "red", 4, "#2")), str(tmp_path), "alert_metadata")
    sinks.upsert_landing(frame(ddl, ("phenomenon", "1", "storm", None, None), ("color", "1", "rouge", None, "#3")), str(tmp_path), "alert_metadata")
    got = rows(sinks.read_landing(spark, str(tmp_path), "alert_metadata"))
    assert got == [("color", "1", "rouge", None, "#3"), ("phenomenon", "1", "storm", 3, "#1")]


def test_row_id_and_first_creation_stay(spark, frame, tmp_path):
    ddl, base = LANDING["authors"].ddl, str(tmp_path)
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 1, 9)
    for stamp, name in ((first, "A"), (second, "B")):
        rows_ = frame(ddl, ("s", name, None, None, None, stamp, ONE), (None, name, None, None, None, stamp, ONE))
        sinks.upsert_landing(rows_, base, "authors", created_at=F.lit(stamp))
    got = {(r["slug"], r["name"]): r for r in sinks.read_landing(spark, base, "authors").collect()}
    assert set(got) == {("s", "B"), (None, "A"), (None, "B")}
    kept = got["s", "B"]
    assert (kept["created_at"], kept["extracted_at"]) == (first, second)
    assert len({r["id"] for r in got.values()}) == 3 and None not in {r["id"] for r in got.values()}


ALERT = "k int, d date, v string, extracted_at int"


def test_replayed_batch_changes_nothing(spark, frame, tmp_path, monkeypatch):
    folder, out, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    schema = frame(ALERT, (1, ONE, "a", 1)).schema

    def run():
        query = upsert_stream(stream_files(spark, folder, schema), out, state, ["k", "d"], partition_by="d")
        query.awaitTermination()

    frame(ALERT, (1, ONE, "a", 1)).write.mode("append").parquet(folder)
    run()
    frame(ALERT, (1, ONE, "b", 2), (2, TWO, "b", 2)).write.mode("append").parquet(folder)
    real = versions.clean

    def stop(*args):
        real(*args)
        raise Stopped("after the write, before the stream's own commit")

    with monkeypatch.context() as patch:
        patch.setattr(versions, "clean", stop)
        with pytest.raises(Exception, match="before the stream's own commit"):
            run()
    # Another writer corrects the row meanwhile; the replay must not undo that.
    fixed = frame(ALERT, (1, ONE, "fixed", 3))
    sinks.upsert_table(fixed, out, schema, ["k", "d"], partition_by="d")
    run()
    assert rows(versions.read_table(spark, out, schema)) == [(1, ONE, "fixed", 3), (2, TWO, "b", 2)]
    frame(ALERT, (2, TWO, "c", 4)).write.mode("append").parquet(folder)
    run()
    assert rows(versions.read_table(spark, out, schema)) == [(1, ONE, "fixed", 3), (2, TWO, "c", 4)]
    assert len(glob.glob(f"{out}/d=*")) == 2


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")
def test_gate_judges_the_data(spark, tmp_path):
    tables = Tables(spark, SMALL)
    landing = {n: getattr(tables, n) for n in ("alerts", "commune_profiles", "risk_details", "books", "quotes", "authors")}
    with pytest.raises(MartGateError, match="data of rpt_book_stats"):
        refresh(spark, landing, str(tmp_path), "2024-02-01 00:00:00", max_data_age_days={"rpt_book_stats": 10})


def test_partitions_without_rows_can_go(spark, frame, tmp_path):
    path, ddl = f"{tmp_path}/t", "a string, b string, n int"
    sinks.replace_partitions(frame(ddl, ("x", "1", 1), ("x", "2", 2)), path, ["a", "b"])
    none = frame(ddl, ("x", "1", 1)).where("false")
    sinks.replace_partitions(none, path, ["a", "b"], ["a=x/b=1", "a=y/b=1"])
    assert rows(versions.read_table(spark, path)) == [("x", "2", 2)]
    sinks.replace_partitions(frame(ddl, ("x", "2", 3)), path, ["a", "b"], ["a=x/b=2"])
    assert rows(versions.read_table(spark, path)) == [("x", "2", 3)]
