"""Nested documents to landing tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.functions import digits_or_zero, epoch_millis, first_filled, severity, truncate
from lakeweir.operators.enrich import DEFAULT_COLOR, UNKNOWN_PHENOMENON, UNKNOWN_PLACE, enrich
from lakeweir.operators.rows import computed
from lakeweir.sources.schemas import ALERT_DOCUMENT, RISK_ENTRY, RISK_SECTION

NATURAL, TECHNOLOGICAL = "naturel", "technologique"

# Risk keys that get columns of their own, and which of those they get.
INDICATORS: Mapping[str, tuple[str, tuple[str, ...]]] = {
    "seisme": ("seisme", ("present", "severity")),
    "retraitGonflementArgile": ("rga", ("present", "severity", "statut")),
    "radon": ("radon", ("present", "severity")),
    "inondation": ("inondation", ("present", "severity")),
    "icpe": ("icpe", ("present",)),
    "nucleaire": ("nucleaire", ("present",)),
}


def open_alert_documents(documents: DataFrame, text: str = "document") -> DataFrame:
    """JSON text column to ``timelaps``; other columns stay. Files are read with ALERT_DOCUMENT as schema."""
    opened = computed(documents, {"__document": F.from_json(F.col(text), ALERT_DOCUMENT)})
    return opened.select(*[c for c in documents.columns if c != text], F.col("__document.timelaps").alias("timelaps"))


def alert_rows(
    documents: DataFrame, phenomena: DataFrame, colors: DataFrame, departments: DataFrame
) -> DataFrame:
    """``timelaps[] x timelaps_items[]`` to one row per department, phenomenon and interval.

    ``documents`` has ``timelaps``, ``extracted_at`` and ``extraction_date``. If one of the two
    times is unreadable both are NULL. Dictionaries: phenomena(id, name), colors(id, name, level,
    hexaCode), departments(code, name).
    """
    entries = documents.select("extracted_at", "extraction_date", F.inline("timelaps"))
    items = entries.select("extracted_at", "extraction_date", "domain_id", F.inline("timelaps_items"))
    begin, end = epoch_millis(F.col("begin_time")), epoch_millis(F.col("end_time"))
    both = begin.isNotNull() & end.isNotNull()
    rows = items.select(
        F.coalesce("domain_id", F.lit("")).alias("department_code"),
        F.col("phenomenon_id").alias("phenomenon_text"),
        F.col("color_id").alias("color_text"),
        F.coalesce(digits_or_zero(F.col("phenomenon_id")), F.lit(0)).alias("phenomenon_id"),
        F.coalesce(digits_or_zero(F.col("color_id")), F.lit(0)).alias("color_id"),
        F.when(both, begin).alias("begin_time"),
        F.when(both, end).alias("end_time"),
        "extracted_at",
        "extraction_date",
    )
    rows = enrich(rows, departments, F.col("department_code"), "code", {"department_name": ("name", UNKNOWN_PLACE)})
    rows = enrich(rows, phenomena, F.col("phenomenon_text"), "id", {"phenomenon_name": ("name", UNKNOWN_PHENOMENON)})
    rows = enrich(
        rows,
        colors,
        F.col("color_text"),
        "id",
        {
            "color_name": ("name", DEFAULT_COLOR["name"]),
            "color_level": ("level", DEFAULT_COLOR["level"]),
            "color_hex": ("hexaCode", DEFAULT_COLOR["hexaCode"]),
        },
    )
    return rows.select(
        "department_code", "department_name", "phenomenon_id", "phenomenon_name", "begin_time",
        "end_time", "color_id", "color_name", "color_level", "color_hex", "extracted_at", "extraction_date",
    )


def split_reports(documents: DataFrame, text: str = "document") -> DataFrame:
    """An object keyed by commune code, as JSON text, to (insee_code, report text, other columns)."""
    others = [c for c in documents.columns if c != text]
    opened = computed(documents, {"__reports": F.from_json(F.col(text), "map<string,string>")})
    return opened.select(*others, F.explode("__reports").alias("insee_code", "report"))


def _section(entries: Column, category: str) -> Column:
    """Entries of one section that are objects, as an array of risk structs.

    Three passes over the array, so that each text is parsed once and each status looked at once;
    inside one lambda every use of the parsed value would parse it again.
    """

    def opened(pair: Column) -> Column:
        return F.struct(pair["key"].alias("key"), F.from_json(pair["value"], RISK_ENTRY).alias("body"))

    def told(entry: Column) -> Column:
        body = entry["body"]
        status = first_filled(body["libelleStatutCommune"], F.coalesce(body["libelleStatutAdresse"], F.lit("")))
        return F.struct(entry["key"].alias("key"), body.alias("body"), severity(status).alias("level"))

    def risk(entry: Column) -> Column:
        body, level = entry["body"], entry["level"]
        return F.struct(
            F.lit(category).alias("risk_category"),
            entry["key"].alias("risk_key"),
            F.coalesce(body["libelle"], entry["key"]).alias("libelle"),
            F.coalesce(body["present"], F.lit(False)).alias("present"),
            F.coalesce(body["libelleStatutCommune"], F.lit("")).alias("statut_commune"),
            F.coalesce(body["libelleStatutAdresse"], F.lit("")).alias("statut_adresse"),
            level["label"].alias("severity_label"),
            level["score"].alias("severity_score"),
        )

    objects = F.filter(F.map_entries(entries), lambda pair: F.ltrim(pair["value"]).startswith("{"))
    risks = F.transform(F.transform(F.transform(objects, opened), told), risk)
    return F.coalesce(risks, F.array())


def parse_reports(reports: DataFrame) -> DataFrame:
    """Report text to (insee_code, commune, code_postal, risks[], other columns).

    Sections are read as ``map<string,string>`` and each value on its own: with a typed map one
    scalar among the values would lose the whole section. One report stays one row; nothing is
    shuffled.
    """
    others = [c for c in reports.columns if c not in ("insee_code", "report")]
    body = F.from_json(
        F.col("report"),
        "commune struct<libelle: string, codePostal: string>, "
        f"risquesNaturels {RISK_SECTION}, risquesTechnologiques {RISK_SECTION}",
    )
    opened = computed(reports.select("insee_code", *others, "report"), {"body": body}).drop("report")
    risks = F.concat(
        _section(F.col("body.risquesNaturels"), NATURAL),
        _section(F.col("body.risquesTechnologiques"), TECHNOLOGICAL),
    )
    return computed(opened, {"risks": risks}).select(
        "insee_code",
        F.coalesce("body.commune.libelle", F.lit("")).alias("commune"),
        F.coalesce("body.commune.codePostal", F.lit("")).alias("code_postal"),
        "risks",
        *others,
    )


def risk_rows(parsed: DataFrame) -> DataFrame:
    """One row per commune and risk."""
    others = [c for c in parsed.columns if c not in ("insee_code", "commune", "code_postal", "risks")]
    return parsed.select("insee_code", *others, F.inline("risks"))


def detail_rows(parsed: DataFrame, risk_types: DataFrame) -> DataFrame:
    """Risk rows with their label: the dictionary's (key, label), else the report's own."""
    rows = enrich(risk_rows(parsed), risk_types, F.col("risk_key"), "key", {"__label": ("label", None)})
    return rows.withColumn("risk_libelle", F.coalesce("__label", "libelle")).drop("__label", "libelle")


def _measures(risks: Column) -> dict[str, Column]:
    """Counts of present risks and their greatest severity, from the report's own array."""

    def present(category: str) -> Column:
        return F.filter(risks, lambda r: r["present"] & (r["risk_category"] == category))

    def worst(category: str) -> Column:
        scores = F.transform(present(category), lambda r: r["severity_score"])
        return F.coalesce(F.array_max(scores), F.lit(0))

    return {
        "naturels_count": F.size(present(NATURAL)),
        "technologiques_count": F.size(present(TECHNOLOGICAL)),
        "total_risks": F.size(F.filter(risks, lambda r: r["present"])),
        "max_severity_naturels": worst(NATURAL),
        "max_severity_technologiques": worst(TECHNOLOGICAL),
    }


def _indicator_columns(found: Mapping[str, Column]) -> dict[str, Column]:
    """Columns of INDICATORS from one struct (or NULL) per risk key."""
    columns = {}
    for key, (stem, parts) in INDICATORS.items():
        risk = found[key]
        for part in parts:
            if part == "present":
                columns[f"{stem}_present"] = F.coalesce(risk["present"], F.lit(False))
            elif part == "severity":
                columns[f"{stem}_severity"] = F.coalesce(risk["severity_score"], F.lit(0))
            else:
                status = first_filled(risk["statut_commune"], risk["statut_adresse"])
                columns[f"{stem}_statut"] = F.coalesce(status, F.lit(""))
    return columns


def profile_rows(parsed: DataFrame, departments: DataFrame) -> DataFrame:
    """One wide row per report: measures, indicator columns, department and region.

    The department is the first two characters of the postal code. All measures come from the
    report's own array, so the only join is with the departments dictionary.
    """
    risks = F.col("risks")

    def last(key: str) -> Column:
        return F.get(F.reverse(F.filter(risks, lambda r: r["risk_key"] == key)), F.lit(0))

    found = {key: last(key) for key in INDICATORS}
    others = [c for c in parsed.columns if c != "risks"]
    wide = parsed.select(
        *others,
        truncate(F.col("code_postal"), 2).alias("department_code"),
        *[c.alias(name) for name, c in {**_measures(risks), **_indicator_columns(found)}.items()],
    )
    return enrich(
        wide,
        departments,
        F.col("department_code"),
        "code",
        {"department_name": ("name", UNKNOWN_PLACE), "region": ("region", UNKNOWN_PLACE)},
    )


def risk_metrics(details: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same measures from detail rows, where reports are no longer at hand."""
    present = F.col("present")

    def measures(category: str, stem: str) -> list[Column]:
        hit = present & (F.col("risk_category") == category)
        return [
            F.count_if(hit).alias(f"{stem}_count"),
            F.coalesce(F.max(F.when(hit, F.col("severity_score"))), F.lit(0)).alias(f"max_severity_{stem}"),
        ]

    return details.groupBy(*keys).agg(
        *measures(NATURAL, "naturels"),
        *measures(TECHNOLOGICAL, "technologiques"),
        F.count_if(present & F.col("risk_category").isin(NATURAL, TECHNOLOGICAL)).alias("total_risks"),
    )


def risk_pivot(details: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Indicator columns from detail rows; a repeated risk key counts with its last row by ``order``."""
    body = F.struct("present", "severity_score", "statut_commune", "statut_adresse")
    by = F.struct(*order)
    picked = details.groupBy(*keys).agg(
        *[
            F.max_by(body, F.when(F.col("risk_key") == key, by)).alias(f"__{stem}")
            for key, (stem, _) in INDICATORS.items()
        ]
    )
    found = {key: F.col(f"__{stem}") for key, (stem, _) in INDICATORS.items()}
    return picked.select(*keys, *[c.alias(name) for name, c in _indicator_columns(found).items()])


def metadata_rows(phenomena: DataFrame, colors: DataFrame) -> DataFrame:
    """Dictionary entries as (type, code, name, level, hex_code)."""
    named = phenomena.select(
        F.lit("phenomenon").alias("type"),
        F.col("id").cast("string").alias("code"),
        "name",
        F.lit(None).cast("int").alias("level"),
        F.lit(None).cast("string").alias("hex_code"),
    )
    tinted = colors.select(
        F.lit("color").alias("type"),
        F.col("id").cast("string").alias("code"),
        "name",
        F.col("level").cast("int").alias("level"),
        F.col("hexaCode").alias("hex_code"),
    )
    return named.unionByName(tinted)
