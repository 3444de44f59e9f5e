"""Column expressions. All of them stay inside Catalyst; none is a UDF."""

from lakeweir.functions.classify import band, flag_positive, severity, word_rating
from lakeweir.functions.keys import content_hash, surrogate_key
from lakeweir.functions.numbers import (
    clamp,
    digits_or_zero,
    fixed_text,
    guarded_ratio,
    rounded_average,
    rounded_decimal,
    to_number,
)
from lakeweir.functions.text import (
    absolute_url,
    captured_int,
    clean,
    cut_lead_in,
    first_filled,
    first_number,
    last_path_part,
    slug_from_name,
    strip_curly_quotes,
    strip_parent_steps,
    title_case,
    truncate,
)
from lakeweir.functions.times import (
    age_in_days,
    age_in_seconds,
    date_parts,
    epoch_millis,
    hours_between,
)

__all__ = [
    "absolute_url",
    "age_in_days",
    "age_in_seconds",
    "band",
    "captured_int",
    "clamp",
    "clean",
    "content_hash",
    "cut_lead_in",
    "date_parts",
    "digits_or_zero",
    "epoch_millis",
    "first_filled",
    "first_number",
    "fixed_text",
    "flag_positive",
    "guarded_ratio",
    "hours_between",
    "last_path_part",
    "rounded_average",
    "rounded_decimal",
    "severity",
    "slug_from_name",
    "strip_curly_quotes",
    "strip_parent_steps",
    "surrogate_key",
    "title_case",
    "to_number",
    "truncate",
    "word_rating",
]
