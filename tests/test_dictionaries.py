"""Dictionary lookups of every size give the same rows; map-shaped dictionary documents."""

import json

import pytest
from pyspark.sql import functions as F

from lakeweir.operators import enrich
from lakeweir.sources.documents import read_dictionaries
from tests.conftest import rows

SIZES = {"map": {}, "broadcast": {"map_entries": 0}, "shuffle": {"map_entries": 0, "broadcast_entries": 0}}


@pytest.mark.parametrize("kind", sorted(SIZES))
def test_sizes_agree(spark, frame, kind):
    entries = frame("id int, name string, level int", (1, "one", 1), (1, "uno", 9), (2, None, 2), (None, "never", 3))
    facts = frame("n int, ref string, name string", (1, "1", "x"), (2, "2", "x"), (3, "3", "x"), (4, None, "x"), (5, "1", "x"), (5, "1", "x"))
    got = enrich.enrich(facts, entries, F.col("ref"), "id", {"name": ("name", "none"), "rank": ("level", None)}, **SIZES[kind])
    assert got.columns == ["n", "ref", "name", "rank"]
    assert rows(got) == sorted(
        [(1, "1", "uno", 9), (2, "2", "none", 2), (3, "3", "none", None), (4, None, "none", None), (5, "1", "uno", 9), (5, "1", "uno", 9)], key=repr
    )
    empty = enrich.enrich(facts, entries.where("false"), F.col("ref"), "id", {"rank": ("level", 0)}, **SIZES[kind])
    assert {r["rank"] for r in empty.collect()} == {0}


def test_small_dictionaries_need_no_join(spark, frame):
    entries = frame("id string, name string", ("1", "one"))
    facts = spark.range(100).select(F.col("id").cast("string").alias("ref"))
    plan = enrich.enrich(facts, entries, F.col("ref"), "id", {"name": ("name", "none")})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_no_task_holds_one_id(spark, frame):
    """With a dictionary beyond the broadcast, rows of one id and rows without one spread over the tasks."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(8000).select(F.when(F.col("id") % 2 == 0, "1").alias("ref"), "id")
        entries = frame("id string, name string", ("1", "one"), ("2", "two"))
        got = enrich.enrich(facts, entries, F.col("ref"), "id", {"name": ("name", "none")}, map_entries=0, broadcast_entries=0)
        sizes = got.groupBy(F.spark_partition_id().alias("task"), "name").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    assert sum(r["count"] for r in sizes) == 8000
    for name in ("one", "none"):
        assert max(r["count"] for r in sizes if r["name"] == name) < 2400


def test_documents(spark, tmp_path):
    texts = {
        "dictionary": {"phenomenons": [{"id": 1, "name": "wind"}], "colors": [{"id": "3", "name": "orange", "level": 3, "hexaCode": "#f"}]},
        "departments": {"01": {"name": "Ain", "region": "ARA"}, "2A": {"name": "Corse"}, "bad": "text"},
        "risk_types": {"seisme": "Quake", "odd": {"a": 1}},
        "gie_mapping": {"s1": "01", "s2": {"insee_code": "01001", "commune": "A"}, "s3": ["no"]},
    }
    for name, value in texts.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(value, indent=1))
    got = read_dictionaries(spark, str(tmp_path))
    assert rows(got["phenomena"]) == [("1", "wind")] and rows(got["colors"]) == [("3", "orange", 3, "#f")]
    assert rows(got["departments"]) == [("01", "Ain", "ARA"), ("2A", "Corse", None)]
    assert rows(got["risk_types"]) == [("seisme", "Quake")]
    assert rows(got["stores"]) == [("s1", "01")] and rows(got["store_places"]) == [("s2", "01001", "A", None)]
    none = read_dictionaries(spark, str(tmp_path / "missing"))
    assert all(df.count() == 0 for df in none.values())
