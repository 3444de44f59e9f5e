"""Explicit schemas of the landing and monitoring tables, and their natural keys.

Nothing is inferred: department codes such as ``01`` and ``2A`` have to stay text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Table:
    """Columns as DDL, natural key, and the columns a repeated key updates (None: all others).

    ``guards`` hold conditions, as SQL, under which a row may update a column. A landing table with
    ``row_id`` also has ``id``, which follows from the key, and ``created_at``, which later rows of the
    key leave alone.
    """

    ddl: str
    key: tuple[str, ...] = ()
    updates: tuple[str, ...] | None = None
    guards: tuple[tuple[str, str], ...] = ()
    row_id: bool = False

    @property
    def columns(self) -> list[str]:
        return [part.split()[0] for part in self.ddl.split(", ")]

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def landing_schema(self) -> StructType:
        """The table as it is stored."""
        return StructType.fromDDL(f"id bigint, {self.ddl}, created_at timestamp_ntz") if self.row_id else self.schema

    def updated_columns(self) -> list[str]:
        if self.updates is not None:
            return list(self.updates)
        return [c for c in self.columns if c not in self.key]


INDICATORS = (
    "naturels_count int, technologiques_count int, total_risks int, "
    "max_severity_naturels int, max_severity_technologiques int, "
    "seisme_present boolean, seisme_severity int, rga_present boolean, rga_severity int, "
    "rga_statut string, radon_present boolean, radon_severity int, "
    "inondation_present boolean, inondation_severity int, "
    "icpe_present boolean, nucleaire_present boolean"
)
_INDICATOR_NAMES = tuple(part.split()[0] for part in INDICATORS.split(", "))
_STAMPS = "extracted_at timestamp_ntz, extraction_date date"

LANDING: dict[str, Table] = {
    "alerts": Table(
        "department_code string, department_name string, phenomenon_id int, phenomenon_name string, "
        "begin_time timestamp_ntz, end_time timestamp_ntz, color_id int, color_name string, "
        f"color_level int, color_hex string, {_STAMPS}",
        ("department_code", "phenomenon_id", "begin_time", "extraction_date"),
        (
            "department_name", "end_time", "color_id", "color_name",
            "color_level", "color_hex", "extracted_at",
        ),
        row_id=True,
    ),
    "store_alerts": Table(
        "gie_name string, department_code string, department_name string, phenomenon_name string, "
        "begin_time timestamp_ntz, end_time timestamp_ntz, alert_level string, color_hex string, "
        f"{_STAMPS}",
        ("gie_name", "phenomenon_name", "begin_time", "extraction_date"),
        row_id=True,
    ),
    "alert_metadata": Table(
        "type string, code string, name string, level int, hex_code string",
        ("type", "code"),
        # A phenomenon has neither level nor color of its own.
        guards=(("level", "type <> 'phenomenon'"), ("hex_code", "type <> 'phenomenon'")),
    ),
    "commune_profiles": Table(
        "insee_code string, commune string, code_postal string, department_code string, "
        f"department_name string, region string, {INDICATORS}, {_STAMPS}",
        ("insee_code", "extraction_date"),
        ("commune", *_INDICATOR_NAMES, "extracted_at"),
        row_id=True,
    ),
    "store_risks": Table(
        "gie_name string, insee_code string, commune string, postal_code string, "
        f"department_code string, department_name string, region string, {INDICATORS}, {_STAMPS}",
        ("gie_name", "extraction_date"),
        ("insee_code", "commune", *_INDICATOR_NAMES, "extracted_at"),
        row_id=True,
    ),
    "risk_details": Table(
        "insee_code string, risk_category string, risk_key string, risk_libelle string, "
        "present boolean, statut_commune string, statut_adresse string, severity_label string, "
        f"severity_score int, {_STAMPS}",
        ("insee_code", "risk_key", "extraction_date"),
        row_id=True,
    ),
    "books": Table(
        "upc string, title string, price double, price_incl_tax double, tax double, "
        "availability string, stock_count int, star_rating int, category string, "
        f"description string, image_url string, product_url string, {_STAMPS}",
        ("upc", "extraction_date"),
        row_id=True,
    ),
    "quotes": Table(
        f"quote_hash string, text string, author_name string, author_slug string, tags string, {_STAMPS}",
        ("quote_hash", "extraction_date"),
        row_id=True,
    ),
    "authors": Table(
        "slug string, name string, born_date string, born_location string, description string, "
        f"{_STAMPS}",
        ("slug", "extraction_date"),
        row_id=True,
    ),
    "run_metrics": Table(
        "source string, dag_id string, run_date date, items_extracted bigint, items_loaded bigint, "
        "errors bigint, duration_seconds double, started_at timestamp_ntz, finished_at timestamp_ntz",
        ("source", "dag_id", "run_date"),
    ),
}

MONITORING: dict[str, Table] = {
    "source_freshness": Table(
        "source string, state string, age_seconds bigint, interval_seconds bigint, "
        "gap_description string, checked_at timestamp_ntz"
    ),
    "breaker_status": Table(
        "source string, state string, failure_count int, max_failures int, "
        "cooldown_seconds double, checked_at timestamp_ntz"
    ),
    "quality_scores": Table(
        "source string, score double, grade string, freshness_score double, volume_score double, "
        "error_score double, schema_score double, computed_at timestamp_ntz"
    ),
}

# Raw documents. Ids and times arrive as text or numbers; Spark reads both as text.
ALERT_DOCUMENT = (
    "timelaps array<struct<domain_id: string, timelaps_items: array<struct<"
    "phenomenon_id: string, color_id: string, begin_time: string, end_time: string>>>>"
)
RISK_SECTION = "map<string,string>"
RISK_ENTRY = "present boolean, libelle string, libelleStatutCommune string, libelleStatutAdresse string"
