"""Record contracts: typed validation of JSON records, pass-rate gate, schema drift."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.operators.rows import computed

SPARK_TYPE = {"str": "string", "int": "bigint", "float": "double", "bool": "boolean"}
EXTRAS = "metadata_json"

# Texts a boolean field takes for true and for false.
TRUE_TEXT = ["1", "on", "t", "true", "y", "yes"]
FALSE_TEXT = ["0", "off", "f", "false", "n", "no"]


@dataclass(frozen=True)
class Field:
    """One field: ``required`` has to be there, ``nullable`` may be null, else ``default`` fills in."""

    name: str
    kind: str = "str"
    required: bool = True
    nullable: bool = False
    default: object = None
    min_length: int | None = None
    ge: float | None = None
    le: float | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def part(self, *names: str, without: bool = False) -> Contract:
        """The rules of some fields, or of all others."""
        return Contract(self.name, tuple(f for f in self.fields if (f.name in names) != without))


def _need(kind: str, names: str, **limits) -> list[Field]:
    return [Field(n, kind, **limits) for n in names.split()]


def _may(kind: str, names: str, default: object = None) -> list[Field]:
    return [Field(n, kind, required=False, nullable=True, default=default) for n in names.split()]


def _fill(kind: str, names: str, default: object) -> list[Field]:
    return [Field(n, kind, required=False, default=default) for n in names.split()]


def _contract(name: str, *groups: Sequence[Field]) -> Contract:
    fields = [f for group in groups for f in group]
    return Contract(name, tuple(fields + _need("str", "extraction_date extracted_at")))


_FLAGS = "seisme_present rga_present radon_present inondation_present icpe_present nucleaire_present"
_SCORES = "seisme_severity rga_severity radon_severity inondation_severity"
_COUNTS = (
    "naturels_count technologiques_count total_risks max_severity_naturels max_severity_technologiques"
)
_INDICATOR_FIELDS = (
    _fill("bool", _FLAGS, False) + _fill("int", _SCORES, 0) + _may("str", "rga_statut", "")
)

CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in [
        _contract(
            "book",
            _need("str", "upc", min_length=2),
            _need("str", "title category"),
            _need("int", "star_rating", ge=1, le=5),
            _need("float", "price price_incl_tax tax", ge=0),
            _need("str", "availability"),
            _need("int", "stock_count", ge=0),
            _may("str", "description"),
            _need("str", "image_url product_url"),
        ),
        _contract("quote", _need("str", "quote_hash text author_name tags"), _may("str", "author_slug")),
        _contract("author", _need("str", "slug name"), _may("str", "born_date born_location description")),
        _contract(
            "alert",
            _need("str", "department_code department_name phenomenon_name color_name color_hex"),
            _need("int", "phenomenon_id color_id color_level"),
            _may("str", "begin_time end_time"),
        ),
        # The store alert job emits alert_level, not the colour and phenomenon ids.
        _contract(
            "store_alert",
            _need("str", "gie_name department_code department_name phenomenon_name alert_level color_hex"),
            _may("str", "begin_time end_time"),
        ),
        _contract(
            "commune_profile",
            _need("str", "insee_code commune code_postal department_code department_name region"),
            _need("int", _COUNTS),
            _INDICATOR_FIELDS,
        ),
        _contract(
            "store_risk",
            _need("str", "gie_name insee_code commune postal_code department_code department_name region"),
            _need("int", _COUNTS),
            _INDICATOR_FIELDS,
        ),
        _contract(
            "risk_detail",
            _need("str", "insee_code risk_category risk_key severity_label"),
            _may("str", "risk_libelle statut_commune statut_adresse", ""),
            _need("bool", "present"),
            _need("int", "severity_score"),
        ),
        _contract(
            "recipe",
            _need("str", "recipe_id title recipe_url"),
            _may("str", "image_url recipe_yield difficulty budget author ingredients"),
            _may("int", "prep_time_minutes cook_time_minutes total_time_minutes review_count"),
            _may("float", "rating"),
        ),
        _contract(
            "game_deal",
            _need("str", "gog_id title"),
            _may("str", "slug developer publisher release_date genres features cover_url"),
            _may("float", "price original_price discount_pct rating"),
            _may("bool", "is_in_development"),
        ),
        _contract(
            "shop_deal",
            _need("str", "deal_id title deal_url"),
            _may("str", "description merchant category image_url expires_at"),
            _may("float", "price original_price discount_pct"),
            _may("int", "temperature comment_count"),
        ),
    ]
}


def _coerced(f: Field, kind: Column, text: Column) -> Column:
    """Value of a JSON item under the lax rules, NULL where the item does not fit the type.

    Text takes only JSON strings. Integers take whole numbers and digits in text. Floats take
    numbers and numeric text. Booleans take 0, 1 and the usual words.
    """
    number = kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT|INT|SMALLINT|TINYINT)")
    string, boolean = kind == "STRING", kind == "BOOLEAN"
    as_bit = F.when(text == "true", F.lit(1)).otherwise(F.lit(0))
    if f.kind == "str":
        return F.when(string, text)
    if f.kind == "int":
        whole = F.trim(text).rlike(r"^[+-]?[0-9]+(\.0*)?$")
        digits = F.regexp_replace(F.trim(text), r"\.0*$", "").try_cast("bigint")
        floating = text.try_cast("double")
        integral = F.when(floating == F.floor(floating), floating.try_cast("bigint"))
        return (
            F.when(boolean, as_bit.cast("bigint"))
            .when(string, F.when(whole, digits))
            .when(number, F.coalesce(F.when(whole, digits), integral))
        )
    if f.kind == "float":
        return F.when(boolean, as_bit.cast("double")).when(number | string, F.trim(text).try_cast("double"))
    if f.kind == "bool":
        word = F.lower(text)
        parsed = F.when(word.isin(TRUE_TEXT), F.lit(True)).when(word.isin(FALSE_TEXT), F.lit(False))
        numeric = F.when(text.try_cast("double") == 1, F.lit(True)).when(text.try_cast("double") == 0, F.lit(False))
        return F.when(boolean | string, parsed).when(number, numeric)
    raise ValueError(f.kind)


def _limit_errors(f: Field, value: Column) -> list[Column]:
    # NaN fulfils no limit, though it is ordered above all numbers here.
    nan = F.isnan(value) if f.kind == "float" else F.lit(False)
    checks = []
    if f.min_length is not None:
        checks.append((F.length(value) < f.min_length, "min_length"))
    if f.ge is not None:
        checks.append((~(value >= f.ge) | nan, "ge"))
    if f.le is not None:
        checks.append((~(value <= f.le) | nan, "le"))
    return [F.when(broken, F.lit(f"{f.name}:{rule}")) for broken, rule in checks]


def validate_json(df: DataFrame, raw: str, contract: Contract) -> DataFrame:
    """JSON object text in ``raw`` to typed contract columns, ``metadata_json`` and ``errors``.

    ``errors`` lists ``field:rule`` for every broken rule; an empty list is a valid record. Keys
    the contract does not name are kept, with their JSON types, in ``metadata_json``. Columns
    other than ``raw`` pass through.
    """
    others = [c for c in df.columns if c != raw and c not in (*contract.names, EXTRAS, "errors")]
    parsed = computed(df.select(*others, F.col(raw).alias("__raw")), {"__v": F.try_parse_json("__raw")})
    items = {"__object": F.col("__v").isNotNull() & F.schema_of_variant("__v").startswith("OBJECT")}
    for f in contract.fields:
        items[f"__t_{f.name}"] = F.try_variant_get("__v", f"$.{f.name}", "string")
        items[f"__k_{f.name}"] = F.schema_of_variant(F.try_variant_get("__v", f"$.{f.name}", "variant"))
    opened = computed(parsed, items).drop("__v")
    typed = computed(
        opened, {f.name: _coerced(f, F.col(f"__k_{f.name}"), F.col(f"__t_{f.name}")) for f in contract.fields}
    )
    errors = [F.when(~F.col("__object"), F.lit("record:not_an_object"))]
    for f in contract.fields:
        kind, value = F.col(f"__k_{f.name}"), F.col(f.name)
        if f.required:
            errors.append(F.when(F.col("__object") & kind.isNull(), F.lit(f"{f.name}:missing")))
        wrong = kind.isNotNull() & value.isNull()
        if f.nullable:
            wrong = wrong & (kind != "VOID")
        errors.append(F.when(wrong, F.lit(f"{f.name}:type")))
        errors += _limit_errors(f, value)
    filled = []
    for f in contract.fields:
        value = F.col(f.name)
        if f.default is not None:
            value = F.when(F.col(f"__k_{f.name}").isNull(), F.lit(f.default)).otherwise(value)
        filled.append(value.cast(SPARK_TYPE[f.kind]).alias(f.name))
    extras = F.map_filter(
        F.from_json(F.col("__raw"), "map<string,variant>"), lambda k, _: ~k.isin(contract.names)
    )
    result = computed(
        typed, {"__extras": F.when(F.col("__object"), extras), "errors": F.array_compact(F.array(*errors))}
    )
    return result.select(
        *others,
        *filled,
        F.when(F.size("__extras") > 0, F.to_json("__extras")).alias(EXTRAS),
        "errors",
    )


def _column_rules(df: DataFrame, contract: Contract) -> tuple[list[Column], list[Column]]:
    """(values in contract types, rule texts) of a typed frame."""
    have = {c: df.schema[c].dataType.simpleString() for c in df.columns}
    errors, values = [], []
    for f in contract.fields:
        if f.name not in have:
            errors.append(F.lit(f"{f.name}:missing") if f.required else F.lit(None))
            values.append(F.lit(f.default).cast(SPARK_TYPE[f.kind]).alias(f.name))
            continue
        raw = F.col(f.name)
        textual = f.kind == "str" and have[f.name] != "string"
        value = raw.cast("string") if textual else raw.try_cast(SPARK_TYPE[f.kind])
        bad = F.lit(False) if f.nullable else raw.isNull()
        errors.append(F.when(bad | (raw.isNotNull() & value.isNull()), F.lit(f"{f.name}:type")))
        errors += _limit_errors(f, value)
        values.append(value.alias(f.name))
    return values, errors


def mark_errors(df: DataFrame, contract: Contract) -> DataFrame:
    """A typed frame as it is, with the list of broken contract rules in ``errors``."""
    _, errors = _column_rules(df, contract)
    return computed(df, {"errors": F.array_compact(F.array(*errors))})


def validate_columns(df: DataFrame, contract: Contract) -> DataFrame:
    """Contract rules on a frame that is typed already; other columns go to ``metadata_json``.

    A column the frame lacks breaks every record, as a missing field would.
    """
    values, errors = _column_rules(df, contract)
    extra = [c for c in df.columns if c not in (*contract.names, EXTRAS)]
    metadata = F.to_json(F.struct(*extra)) if extra else F.lit(None).cast("string")
    return df.select(*values, metadata.alias(EXTRAS), F.array_compact(F.array(*errors)).alias("errors"))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid records without ``errors``, invalid records with it)."""
    return validated.where(F.size("errors") == 0).drop("errors"), validated.where(F.size("errors") > 0)


def pass_rate(validated: DataFrame, pipeline: str) -> DataFrame:
    """One row: (pipeline, total_records, valid_records, error_records, pass_rate)."""
    return rate_of(
        validated.agg(F.count("*").alias("total_records"), F.count_if(F.size("errors") == 0).alias("valid_records")), pipeline
    )


def paired_pass_rate(left: DataFrame, right: DataFrame, on: str, pipeline: str) -> DataFrame:
    """``pass_rate`` of the join of two marked frames, from counts per value of ``on``; no row is joined.

    Rules look at one column each, so a joined row is valid where both of its sides are.
    """

    def sizes(side: DataFrame) -> DataFrame:
        return side.groupBy(on).agg(F.count("*").alias("n"), F.count_if(F.size("errors") == 0).alias("ok"))

    both = sizes(left).alias("l").join(sizes(right).alias("r"), on)
    none = F.lit(0).cast("long")
    return rate_of(
        both.agg(
            F.coalesce(F.sum(F.col("l.n") * F.col("r.n")), none).alias("total_records"),
            F.coalesce(F.sum(F.col("l.ok") * F.col("r.ok")), none).alias("valid_records"),
        ),
        pipeline,
    )


def rate_of(counts: DataFrame, pipeline: str) -> DataFrame:
    """The row of ``pass_rate`` from one of (total_records, valid_records)."""
    return counts.select(
        F.lit(pipeline).alias("pipeline"),
        "total_records",
        "valid_records",
        (F.col("total_records") - F.col("valid_records")).alias("error_records"),
        F.when(F.col("total_records") > 0, F.col("valid_records") / F.col("total_records")).alias("pass_rate"),
    )


class QualityGateError(ValueError):
    """Too few records fit the contract, or there are none."""


def enforce_pass_rate(rate: DataFrame, minimum: float = 0.90) -> float:
    """The pass rate; raises if it is below ``minimum`` or if there was no record at all."""
    row = rate.first()
    if row["total_records"] == 0:
        raise QualityGateError(f"{row['pipeline']}: no records to validate")
    if row["pass_rate"] < minimum:
        raise QualityGateError(f"{row['pipeline']}: pass rate {row['pass_rate']:.2f} is below {minimum:.2f}")
    return row["pass_rate"]


def error_summary(validated: DataFrame) -> DataFrame:
    """Number of records per broken rule."""
    return validated.select(F.explode("errors").alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def schema_drift(df: DataFrame, raw: str, contract: Contract) -> DataFrame:
    """Distinct drift shapes (extra_fields, missing_fields) with their number of records.

    A shape is reported when a record has fields the contract does not name; missing fields alone
    are a matter of validation.
    """
    expected = F.array(*[F.lit(n) for n in contract.names])
    keys = F.col("__keys")
    opened = computed(df.select(raw), {"__keys": F.json_object_keys(raw)})
    shapes = opened.select(
        F.array_sort(F.array_except(keys, expected)).alias("extra_fields"),
        F.array_sort(F.array_except(expected, keys)).alias("missing_fields"),
    ).where(F.size("extra_fields") > 0)
    return shapes.groupBy("extra_fields", "missing_fields").agg(F.count("*").alias("records"))
