"""Column expressions for star-schema keys and labels (all JVM-side).

Conventions: dimension keys are text, the sentinel key is ``'0'``, and date
keys are ``yyyyMMdd`` text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SENTINEL_KEY = "0"
SENTINEL_LABEL = "Unknown"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fk(col: Column | str) -> Column:
    """Foreign key with sentinel default: ``coalesce(cast(x as string), '0')``."""
    return F.coalesce(_c(col).cast("string"), F.lit(SENTINEL_KEY))


def date_key(col: Column | str) -> Column:
    """``yyyyMMdd`` text of a date/timestamp; NULL becomes the sentinel ``'0'``.

    Format keys last: a filter on the raw timestamp pushes to the scan, a
    filter on the formatted key does not.
    """
    return F.coalesce(F.date_format(_c(col), "yyyyMMdd"), F.lit(SENTINEL_KEY))


def parse_date_key(col: Column | str) -> Column:
    """Date from a ``yyyyMMdd`` key; the sentinel, blanks and bad text give NULL."""
    k = F.trim(_c(col).cast("string"))
    return F.when((k == "") | (k == SENTINEL_KEY), F.lit(None).cast("date")).otherwise(
        F.try_to_date(k, "yyyyMMdd")
    )


def json_label(col: Column | str, langs: tuple[str, ...] = ("fr_FR", "en_US"),
               default: str = SENTINEL_LABEL) -> Column:
    """Label of an ERP translatable field.

    Text starting with ``{`` is a JSON object of translations: take the first
    present language in ``langs``, else ``default``. Any other text is kept.
    Malformed JSON yields ``default``.
    """
    txt = _c(col).cast("string")
    picks = [F.get_json_object(txt, f"$.{lang}") for lang in langs]
    return F.when(F.left(txt, F.lit(1)) == "{", F.coalesce(*picks, F.lit(default))).otherwise(txt)


def normalized_label(col: Column | str) -> Column:
    """Case- and blank-insensitive join key for label dimensions."""
    return F.lower(F.trim(_c(col)))


def ts_lit(value) -> Column:
    """``TIMESTAMP_NTZ`` literal from a wall-clock value, free of time zones.

    ``F.lit(datetime)`` converts a naive datetime through the Python
    process's local zone; going through ISO text keeps the wall-clock value
    whatever the process and session zones are. Aware datetimes are taken
    in UTC.
    """
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    if isinstance(value, dt.date):
        return F.lit(value.isoformat()).cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def date_lit(value) -> Column:
    """``DATE`` literal from a date (or the date part of a datetime)."""
    if isinstance(value, dt.datetime):
        value = value.date()
    return F.lit(value.isoformat()).cast("date")
