"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text that stands for NULL inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column) -> Column:
    """MD5 of the parts joined with hyphens. NULL parts are hashed too, so the key is never NULL.

    Do not key on doubles: their text form differs between engines.
    """
    parts = [F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def content_hash(*cols: Column) -> Column:
    """First 16 hex digits of the SHA-256 of the parts joined with a bar; NULL if a part is NULL."""
    joined = cols[0]
    for c in cols[1:]:
        joined = F.concat(joined, F.lit("|"), c)
    return F.left(F.sha2(joined, 256), F.lit(16))
