"""A large JSON object cut by byte ranges gives the members that one parser gives."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lakeweir.operators import normalize
from lakeweir.sources.members import object_members


def opened(spark, path):
    rows = object_members(spark, path).collect()
    found = {}
    for row in sorted(rows, key=lambda r: r["position"]):
        found.update(json.loads(row["document"]))
    return found, rows


def some(dice, depth=0):
    kinds = ["text", "number", "list", "object"] if depth < 3 else ["text", "number"]
    kind = dice.choice(kinds)
    if kind == "text":
        return "".join(dice.choice('ab}{[]",:\\\n\té€') for _ in range(dice.randint(0, 12)))
    if kind == "number":
        return dice.choice([None, True, -1.5, 7])
    if kind == "list":
        return [some(dice, depth + 1) for _ in range(dice.randint(0, 3))]
    return {some(dice, 9) if dice.random() < 0.2 else f"k{k}": some(dice, depth + 1) for k in range(dice.randint(0, 4))}


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("size", [700, 1 << 20])
def test_members_of_one_file(spark, tmp_path, indent, size):
    dice = random.Random(size)
    whole = {}
    for k in range(300):
        if dice.random() < 0.2:
            whole[f"scalar {k}"] = dice.choice([1, None, "}} {", ["a", "}", 2], []])
        whole[f'code "{k}" }}'] = {"first": some(dice), **(value if isinstance(value := some(dice), dict) else {"v": value})}
    whole = json.loads(json.dumps(whole))
    path = tmp_path / "whole.json"
    path.write_text(" " + json.dumps(whole, indent=indent, ensure_ascii=False))
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set(key, str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        found, rows = opened(spark, str(path))
        tasks = spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions()
    finally:
        spark.conf.set(key, before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    last = list(whole)
    while not isinstance(whole[last[-1]], dict):
        last.pop()
    assert found == {k: whole[k] for k in last}
    assert tasks > 20 or size > 700
    assert sorted(r["position"] for r in rows) == list(range(len(rows)))


def test_several_files_and_empty_ones(spark, tmp_path):
    texts = {"a": '{"x": {"n": 1}, "y": {"n": {"m": []}}}', "b": "{}", "c": '{ "z": {} }', "d": '{"only": 1}'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text)
    rows = object_members(spark, str(tmp_path)).collect()
    got = sorted((r["path"][-6], r["position"], r["document"].replace(" ", "")) for r in rows)
    assert got == [("a", 0, '{"x":{"n":1}}'), ("a", 1, '{"y":{"n":{"m":[]}}}'), ("c", 0, '{"z":{}}')]


def test_reports_of_one_file(spark, tmp_path):
    report = lambda n: {"commune": {"libelle": f"C{n}", "codePostal": "01000"}, "risquesNaturels": {"seisme": {"present": n % 2 == 0}, "note": "t}"}}
    path = tmp_path / "reports.json"
    path.write_text(json.dumps({f"{n:05}": report(n) for n in range(50)}))
    documents = object_members(spark, str(path)).select("document")
    got = normalize.risk_rows(normalize.parse_reports(normalize.split_reports(documents)))
    assert got.where(F.col("risk_key") == "seisme").count() == 50 and got.where("present").count() == 25
