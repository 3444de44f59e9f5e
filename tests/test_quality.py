from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeweir.operators import checks, contracts
from lakeweir.operators.checks import Check, Test
from lakeweir.operators.contracts import Contract, Field
from lakeweir.plans.contracts import COLUMN_TESTS, TABLE_CHECKS
from tests.conftest import rows

MIXED = Contract(
    "mixed",
    (
        Field("s"), Field("i", "int", ge=0), Field("f", "float"), Field("b", "bool"),
        Field("o", "int", required=False, nullable=True), Field("d", "bool", required=False, default=False),
    ),
)


@pytest.mark.parametrize(
    "text, errors",
    [
        ('{"s":"x","i":1,"f":1.5,"b":true}', []),
        ('{"s":"x","i":"3","f":"2.5","b":"Yes"}', []),
        ('{"s":"x","i":3.0,"f":1,"b":0}', []),
        ('{"s":"x","i":true,"f":false,"b":1.0}', []),
        ('{"s":"x","i":1,"f":1,"b":true,"o":null}', []),
        ('{"s":1,"i":1,"f":1,"b":true}', ["s:type"]),
        ('{"s":"x","i":3.7,"f":1,"b":true}', ["i:type"]),
        ('{"s":"x","i":"3.7","f":"a","b":"maybe"}', ["i:type", "f:type", "b:type"]),
        ('{"s":null,"i":-1,"f":1,"b":2}', ["s:type", "i:ge", "b:type"]),
        ('{"i":1,"f":1,"b":true,"o":"x"}', ["s:missing", "o:type"]),
        ('{"s":"x","i":[1],"f":{},"b":true,"d":null}', ["i:type", "f:type", "d:type"]),
        ("[1]", ["record:not_an_object"]),
        ("{bad", ["record:not_an_object"]),
        (None, ["record:not_an_object"]),
    ],
)
def test_record_rules(frame, text, errors):
    row = contracts.validate_json(frame("raw string", (text,)), "raw", MIXED).first()
    assert row["errors"] == errors
    if not errors:
        assert row["d"] is False and isinstance(row["i"], int) and isinstance(row["f"], float)


def test_extras_drift_and_split(frame):
    good = '{"s":"x","i":1,"f":1,"b":true'
    df = frame("raw string", (good + "}",), (good + ',"z":{"k":[1,"2"]},"a":7}',), (good + ',"z":1}',), ('{"s":1,"q":2}',))
    checked = contracts.validate_json(df, "raw", MIXED)
    valid, invalid = contracts.split_valid(checked)
    assert (valid.count(), invalid.count()) == (3, 1)
    assert rows(valid.select("metadata_json")) == sorted([(None,), ('{"z":{"k":[1,"2"]},"a":7}',), ('{"z":1}',)], key=repr)
    drift = {tuple(r["extra_fields"]): (r["records"], len(r["missing_fields"])) for r in contracts.schema_drift(df, "raw", MIXED).collect()}
    assert drift == {("a", "z"): (1, 2), ("z",): (1, 2), ("q",): (1, 5)}


def test_gate(frame):
    df = frame("raw string", *[('{"s":"x","i":1,"f":1,"b":true}',)] * 9, ("[]",))
    checked = contracts.validate_json(df, "raw", MIXED)
    assert contracts.enforce_pass_rate(contracts.pass_rate(checked, "p")) == 0.9
    with pytest.raises(contracts.QualityGateError):
        contracts.enforce_pass_rate(contracts.pass_rate(checked, "p"), 0.91)
    with pytest.raises(contracts.QualityGateError):
        contracts.enforce_pass_rate(contracts.pass_rate(checked.where("false"), "p"))


def test_typed_frame(frame):
    df = frame("s string, i int, f double, b boolean, more int", ("x", 1, 1.0, True, 5), (None, -1, 1.0, None, 6))
    got = contracts.validate_columns(df, MIXED).orderBy("i").collect()
    assert [r["errors"] for r in got] == [["s:type", "i:ge", "b:type"], []]
    assert [r["metadata_json"] for r in got] == ['{"more":6}', '{"more":5}']
    assert contracts.validate_columns(df.drop("f"), MIXED).where("array_contains(errors, 'f:missing')").count() == 2


def test_contract_list():
    assert len(contracts.CONTRACTS) == 11
    assert contracts.CONTRACTS["book"].names[0] == "upc"


def outcome(frame_, *check_list, as_of=None):
    return {r["check_name"]: (r["value"], r["outcome"]) for r in checks.run_checks(frame_, list(check_list), as_of).collect()}


def test_checks(frame):
    df = frame("k int, v double, c string", (1, 1.0, "a"), (1, -2.0, None), (None, None, "zz"), (None, 3.0, "b"))
    got = outcome(
        df,
        Check("rows", "row_count", must=(">", 0), warn=("=", 0)),
        Check("tiers", "row_count", fail=("=", 0), warn=("<", 900)),
        Check("dup", "duplicate_count", ("k",), must=("=", 0)),
        Check("gone", "missing_count", ("c",), must=("=", 0)),
        Check("share", "missing_percent", ("c",), must=("<", 25)),
        Check("codes", "invalid_count", ("c",), must=("=", 0), valid_values=("a", "b")),
        Check("range", "invalid_percent", ("v",), must=("<=", 25), valid_min=0),
        Check("re", "invalid_count", ("c",), must=("=", 1), valid_regex="^[ab]$"),
        Check("low", "min", ("v",), must=(">=", 0), where="v IS NOT NULL AND k IS NULL"),
        Check("none", "max", ("v",), must=(">=", 0), where="k = 9"),
        Check("len", "avg_length", ("c",), must=("between", 1, 1.2)),
        Check("sql", "failed_rows", must=("=", 0), condition="v < 0"),
    )
    assert got == {
        "rows": (4, "pass"), "tiers": (4, "warn"), "dup": (1, "fail"), "gone": (1, "fail"), "share": (25, "fail"),
        "codes": (1, "fail"), "range": (25, "pass"), "re": (1, "pass"), "low": (3, "pass"), "none": (None, "not_evaluated"),
        "len": (4 / 3, "fail"), "sql": (1, "fail"),
    }


def test_freshness_check(frame):
    check = Check("f", "freshness", ("t",), must=("<", 10), warn=(">", 10), fail=(">", 20))
    df = frame("t timestamp_ntz", (datetime(2024, 1, 1),))
    for second, want in [(5, "pass"), (15, "warn"), (25, "fail")]:
        as_of = F.lit(datetime(2024, 1, 1, 0, 0, second)).cast("timestamp_ntz")
        assert outcome(df, check, as_of=as_of)["f"] == (second, want)
    assert outcome(df.where("false"), check, as_of=as_of)["f"] == (None, "fail")


def test_enforce(frame):
    df = frame("k int", (1,), (1,))
    with pytest.raises(checks.CheckFailure):
        checks.enforce_checks(checks.run_checks(df, [Check("dup", "duplicate_count", ("k",), must=("=", 0))]))
    assert checks.enforce_checks(checks.run_checks(df, [Check("few", "row_count", warn=("<", 5))])) == ["few"]


def test_schema_rules(frame):
    df = frame("id int, pii_name string, extra int")
    found = checks.check_schema(df, required=["id", "upc"], forbidden=["pii_*"], types={"id": "bigint"}, known=["id", "pii_name"])
    assert found == [("required", "upc", "fail"), ("forbidden", "pii_name", "fail"), ("type", "id", "fail"), ("new", "extra", "warn")]


def test_references_and_change(frame):
    child, parent = frame("p int", (1,), (2,), (None,)), frame("id int", (1,), (1,))
    assert rows(checks.missing_references(child, "p", parent, "id")) == [(2,)]
    log = frame("pipeline string, run_date int, total_records bigint", ("a", 1, 100), ("a", 2, 151), ("b", 1, 5), ("c", 1, 10), ("c", 3, 5))
    got = {r["pipeline"]: (r["change_percent"], r["outcome"]) for r in checks.row_count_change(log).collect()}
    assert got == {"a": (51.0, "warn"), "b": (None, "pass"), "c": (50.0, "pass")}


def test_column_tests(frame):
    df = frame("k int, s int", (1, 1), (1, 9), (None, None), (None, 3))
    tests = [Test("k", "unique"), Test("k", "not_null"), Test("s", "accepted_range", low=1, high=5),
             Test("s", "accepted_values", values=(1, 3), where="s is not null", severity="error")]
    assert rows(checks.run_column_tests(df, tests)) == sorted(
        [("k", "unique", 1, "warn"), ("k", "not_null", 2, "warn"), ("s", "accepted_range", 1, "warn"), ("s", "accepted_values", 1, "error")], key=repr
    )


def test_all_tables_have_rules():
    assert len(TABLE_CHECKS) == 9 and len(COLUMN_TESTS) == 13
