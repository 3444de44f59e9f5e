"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def clean(c: Column) -> Column:
    """Cut spaces (only spaces, not tabs or no-break spaces) at both ends."""
    return F.trim(c)


def title_case(c: Column) -> Column:
    """Capital at the start of every run of letters and digits, as SQL ``initcap`` on Postgres.

    Spark's own ``initcap`` starts words after blanks only: ``sci-fi`` would give ``Sci-fi``.
    """
    words = F.regexp_extract_all(c, F.lit(WORD_OR_GAP), 0)
    capitalised = F.transform(
        words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))
    )
    return F.array_join(capitalised, "")


def truncate(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)


def first_filled(*cols: Column) -> Column:
    """First value that is neither NULL nor empty; the last one is taken as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols[:-1]], cols[-1])


def strip_curly_quotes(c: Column) -> Column:
    return F.btrim(c, F.lit("“”"))


def cut_lead_in(c: Column) -> Column:
    """``in Ulm, Germany`` to ``Ulm, Germany``."""
    return F.regexp_replace(c, "^in ", "")


def slug_from_name(c: Column) -> Column:
    """Blanks to hyphens, dots dropped."""
    return F.translate(c, " .", "-")


def strip_parent_steps(c: Column) -> Column:
    return F.regexp_replace(c, r"^(\.\./)+", "")


def absolute_url(href: Column, base: str, folder: str = "catalogue") -> Column:
    """Absolute address of a listing link; links are relative to the site or to ``folder``."""
    return F.when(href.startswith(f"{folder}/"), F.concat(F.lit(f"{base}/"), href)).otherwise(
        F.concat(F.lit(f"{base}/{folder}/"), strip_parent_steps(href))
    )


def first_number(c: Column) -> Column:
    """First run of digits and dots as a double, NULL if there is none."""
    return F.regexp_extract(c, r"[0-9.]+", 0).try_cast("double")


def captured_int(c: Column, pattern: str) -> Column:
    """Integer in the pattern's first group, 0 if it does not match."""
    return F.coalesce(F.regexp_extract(c, pattern, 1).try_cast("int"), F.lit(0))


def last_path_part(c: Column, folder: str) -> Column:
    """The path part after ``/folder/``, NULL if the link has none."""
    return F.nullif(F.regexp_extract(c, f"/{folder}/([^/]+)", 1), F.lit(""))
