"""Declarative table checks and column tests, fused into few passes.

All checks of a table that are plain aggregates share one pass. Key checks need one more
aggregate each, which combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fnmatch import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Condition = tuple  # ("<", 5), ("between", 10, 500)


def holds(value: Column, condition: Condition) -> Column:
    op, *bounds = condition
    if op == "between":
        return value.between(*bounds)
    bound = bounds[0]
    return {
        "=": lambda: value == bound,
        "!=": lambda: value != bound,
        "<": lambda: value < bound,
        "<=": lambda: value <= bound,
        ">": lambda: value > bound,
        ">=": lambda: value >= bound,
    }[op]()


@dataclass(frozen=True)
class Check:
    """One check: a metric and what has to hold.

    ``fail`` and ``warn`` are alert conditions; where one of them is given they decide, else a
    broken ``must`` is a failure. Metrics: row_count, missing_count, missing_percent,
    duplicate_count, invalid_count, invalid_percent, min, max, avg, avg_length, freshness (age in
    seconds) and failed_rows.
    """

    name: str
    metric: str
    columns: tuple[str, ...] = ()
    must: Condition | None = None
    fail: Condition | None = None
    warn: Condition | None = None
    where: str | None = None
    valid_values: tuple | None = None
    valid_min: float | None = None
    valid_max: float | None = None
    valid_regex: str | None = None
    condition: str | None = None


def _valid(check: Check, c: Column) -> Column:
    rules = []
    if check.valid_values is not None:
        rules.append(c.isin(*check.valid_values))
    if check.valid_min is not None:
        rules.append(c >= check.valid_min)
    if check.valid_max is not None:
        rules.append(c <= check.valid_max)
    if check.valid_regex is not None:
        rules.append(c.cast("string").rlike(check.valid_regex))
    return reduce(lambda a, b: a & b, rules)


def _aggregate(check: Check, as_of: Column | None) -> Column:
    scope = F.expr(check.where) if check.where else F.lit(True)
    rows = F.count_if(scope)
    c = F.col(check.columns[0]) if check.columns else None
    inside = F.when(scope, c) if c is not None else None
    kind = check.metric
    if kind == "row_count":
        value = rows
    elif kind in ("missing_count", "missing_percent"):
        value = F.count_if(scope & c.isNull())
    elif kind in ("invalid_count", "invalid_percent"):
        value = F.count_if(scope & c.isNotNull() & ~_valid(check, c))
    elif kind == "failed_rows":
        value = F.count_if(scope & F.expr(check.condition))
    elif kind in ("min", "max", "avg"):
        value = getattr(F, kind)(inside)
    elif kind == "avg_length":
        value = F.avg(F.length(inside))
    elif kind == "freshness":
        newest = F.max(inside).cast("timestamp_ntz")
        value = (F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(newest.cast("timestamp"))) / F.lit(1e6)
    else:
        raise ValueError(f"{check.name}: unknown metric {kind!r}")
    value = value.cast("double")
    if kind.endswith("_percent"):
        value = F.when(rows > 0, value * 100 / rows).otherwise(F.lit(0.0))
    return value


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values seen more than once, NULLs left out: (keys, n)."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(complete).groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def _outcome(check: Check, value: Column) -> Column:
    verdict = F
    if check.metric == "freshness":
        verdict = verdict.when(value.isNull(), "fail")
    else:
        verdict = verdict.when(value.isNull(), "not_evaluated")
    if check.fail is None and check.warn is None:
        return verdict.when(holds(value, check.must), "pass").otherwise("fail")
    if check.fail is not None:
        verdict = verdict.when(holds(value, check.fail), "fail")
    if check.warn is not None:
        verdict = verdict.when(holds(value, check.warn), "warn")
    return verdict.otherwise("pass")


def run_checks(df: DataFrame, checks: Sequence[Check], as_of: Column | None = None) -> DataFrame:
    """One row per check: (check_name, metric, value, outcome)."""
    plain = [c for c in checks if c.metric != "duplicate_count"]
    keyed = [c for c in checks if c.metric == "duplicate_count"]

    def entry(check: Check, value: Column) -> Column:
        return F.struct(
            F.lit(check.name).alias("check_name"),
            F.lit(check.metric).alias("metric"),
            value.alias("value"),
            _outcome(check, value).alias("outcome"),
        )

    parts = []
    if plain:
        row = df.agg(*[_aggregate(c, as_of).alias(f"v{i}") for i, c in enumerate(plain)])
        parts.append(row.select(F.inline(F.array(*[entry(c, F.col(f"v{i}")) for i, c in enumerate(plain)]))))
    for check in keyed:
        scoped = df.where(check.where) if check.where else df
        row = duplicate_keys(scoped, check.columns).agg(F.count("*").cast("double").alias("v"))
        parts.append(row.select(F.inline(F.array(entry(check, F.col("v"))))))
    return reduce(DataFrame.unionByName, parts)


class CheckFailure(RuntimeError):
    """At least one check failed."""


def enforce_checks(results: DataFrame) -> list[str]:
    """Names of checks that only warn; raises with the names of those that fail."""
    rows = results.select("check_name", "outcome").collect()
    failed = [r["check_name"] for r in rows if r["outcome"] == "fail"]
    if failed:
        raise CheckFailure("; ".join(failed))
    return [r["check_name"] for r in rows if r["outcome"] == "warn"]


def check_schema(
    df: DataFrame,
    *,
    required: Sequence[str] = (),
    forbidden: Sequence[str] = (),
    types: dict[str, str] | None = None,
    known: Sequence[str] | None = None,
) -> list[tuple[str, str, str]]:
    """(rule, column, outcome) of every broken schema rule; only the plan is looked at.

    ``forbidden`` takes patterns such as ``pii_*``. Columns outside ``known`` warn, all else fails.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found = [("required", c, "fail") for c in required if c not in have]
    found += [("forbidden", c, "fail") for c in have if any(fnmatch(c, p) for p in forbidden)]
    found += [("type", c, "fail") for c, t in (types or {}).items() if c in have and have[c] != t]
    if known is not None:
        found += [("new", c, "warn") for c in have if c not in known]
    return found


def missing_references(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose non-NULL ``column`` is not in ``parent``."""
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def row_count_change(counts: DataFrame, limit_percent: float = 50.0) -> DataFrame:
    """Newest run of each pipeline against the one before, from a log (pipeline, run_date, total_records).

    ``outcome`` warns when the count moved by more than ``limit_percent``.
    """
    newest = F.max_by("total_records", "run_date").alias("rows")
    last = counts.groupBy("pipeline").agg(F.max("run_date").alias("run_date"), newest)
    earlier = (
        counts.select("pipeline", F.col("run_date").alias("d"), "total_records")
        .join(last, "pipeline")
        .where(F.col("d") < F.col("run_date"))
        .groupBy("pipeline")
        .agg(F.max_by("total_records", "d").alias("previous_rows"))
    )
    joined = last.join(earlier, "pipeline", "left")
    change = F.when(
        F.col("previous_rows") > 0, F.abs(F.col("rows") - F.col("previous_rows")) * 100.0 / F.col("previous_rows")
    )
    return joined.select(
        "pipeline",
        "run_date",
        "rows",
        "previous_rows",
        change.alias("change_percent"),
        F.when(change > limit_percent, "warn").otherwise("pass").alias("outcome"),
    )


@dataclass(frozen=True)
class Test:
    """Column test: unique, not_null, accepted_range or accepted_values."""

    __test__ = False  # not a pytest class

    column: str
    kind: str
    low: float | None = None
    high: float | None = None
    values: tuple = ()
    where: str | None = None
    severity: str = "warn"


def _broken(test: Test) -> Column:
    """Whether a row breaks a test that looks at one row."""
    c = F.col(test.column)
    if test.kind == "not_null":
        return c.isNull()
    if test.kind == "accepted_range":
        sides = []
        if test.low is not None:
            sides.append(c < test.low)
        if test.high is not None:
            sides.append(c > test.high)
        return reduce(lambda a, b: a | b, sides)
    if test.kind == "accepted_values":
        return ~c.isin(*test.values)
    raise ValueError(test.kind)


@dataclass(frozen=True)
class Reference:
    """Every non-NULL ``column`` of ``model`` has to be a ``parent_column`` of ``parent``."""

    model: str
    column: str
    parent: str
    parent_column: str
    severity: str = "warn"


def run_model_tests(
    models: Mapping[str, DataFrame], tests: Mapping[str, Sequence[Test]], references: Sequence[Reference] = ()
) -> DataFrame:
    """One row per test of every model: (model, column_name, test, failures, status).

    Each model is derived once. A row becomes the (test, key) pairs it has a part in: a key per
    uniqueness test and per side of a reference, and a pair without key for each test it breaks.
    All pairs of all models are counted by one aggregate per key and then by one per test. The
    first combines before its shuffle, so a key that most rows share costs a row per task, and
    broken rows cost one row per task and test.
    """
    described, stacked = [], []

    def describe(model: str, column: str, kind: str, severity: str) -> int:
        described.append(F.struct(
            F.lit(len(described)).alias("__test"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
            F.lit(kind).alias("test"), F.lit(severity).alias("severity"),
        ))
        return len(described) - 1

    def pair(number: int, when: Column, key: Column, parent: bool = False) -> Column:
        return F.when(when, F.struct(F.lit(number).alias("__test"), key.cast("string").alias("__key"), F.lit(parent).alias("__parent")))

    links = [(r, describe(r.model, r.column, "relationship", r.severity)) for r in references]
    unique = set()
    for name, df in models.items():
        pairs = []
        for test in tests.get(name, ()):
            number = describe(name, test.column, test.kind, test.severity)
            scope, c = F.expr(test.where) if test.where else F.lit(True), F.col(test.column)
            if test.kind == "unique":
                unique.add(number)
                pairs.append(pair(number, scope & c.isNotNull(), c))
            else:
                pairs.append(pair(number, scope & _broken(test), F.lit(None)))
        for link, number in links:
            if link.model == name:
                pairs.append(pair(number, F.col(link.column).isNotNull(), F.col(link.column)))
            if link.parent == name:
                pairs.append(pair(number, F.col(link.parent_column).isNotNull(), F.col(link.parent_column), True))
        if pairs:
            stacked.append(df.select(F.inline(F.filter(F.array(*pairs), lambda p: p.isNotNull()))))
    linked = {number for _, number in links}
    keyed = reduce(DataFrame.unionByName, stacked).groupBy("__test", "__key").agg(
        F.count_if(~F.col("__parent")).alias("__rows"), F.bool_or("__parent").alias("__held")
    )
    number, n = F.col("__test"), F.col("__rows")
    failures = (
        F.when(number.isin([*unique, -1]), (n > 1).cast("long")).when(number.isin([*linked, -1]), F.when(F.col("__held"), 0).otherwise(n)).otherwise(n)
    )
    counted = keyed.groupBy("__test").agg(F.sum(failures).alias("__failures"))
    spark = stacked[0].sparkSession
    every = spark.range(1).select(F.inline(F.array(*described)))
    total = F.coalesce("__failures", F.lit(0).cast("long"))
    return every.join(counted, "__test", "left").select(
        "model", "column_name", "test", total.alias("failures"), F.when(total == 0, "pass").otherwise(F.col("severity")).alias("status")
    )


def run_column_tests(df: DataFrame, tests: Sequence[Test]) -> DataFrame:
    """One row per test of one frame: (column_name, test, failures, status)."""
    return run_model_tests({"": df}, {"": tests}).drop("model")
