"""Scalar column functions (X1, X5-X16). Each returns a Column built from built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Column

COMPACT_STAMP = "yyyyMMdd'T'HHmmss'Z'"           # fixed: report file stamp
ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"       # fixed: ISO-8601 UTC text


def _c(c: Column | str) -> Column:
    return c if isinstance(c, _Column) else F.col(c)


def amount_log(c: Column | str = "Amount") -> Column:
    """log(1 + x)."""
    return F.log1p(_c(c))


def hour_of_day_seconds(c: Column | str = "Time") -> Column:
    """Hour of day from seconds: floor(t / 3600) % 24."""
    return (F.floor(_c(c) / 3600) % 24).cast("int")


def bool_to_int(c: Column | str) -> Column:
    return _c(c).cast("int")


def int_to_bool(c: Column | str) -> Column:
    return _c(c).cast("boolean")


def positive_probability(c: Column | str = "probability") -> Column:
    """The positive-class probability from a probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_c(c))[1]


def round_half_up(c: Column | str, places: int) -> Column:
    """Round half away from zero (X8); use ``F.bround`` for half-even."""
    return F.round(_c(c), places)


def row_uid(cols: Sequence[Column | str]) -> Column:
    """Repeatable row id: sha2 of the key columns joined by '|' (X9); ``F.uuid()`` for live rows."""
    return F.sha2(F.concat_ws("|", *[_c(c).cast("string") for c in cols]), 256)


def compact_stamp(ts: Column | str) -> Column:
    """UTC stamp for names, e.g. 20260307T155312Z."""
    return F.date_format(_c(ts), COMPACT_STAMP)


def iso_utc(ts: Column | str) -> Column:
    """ISO-8601 text with offset."""
    return F.date_format(_c(ts), ISO_UTC)


def rewrite_prefix(c: Column | str, pattern: str, replacement: str) -> Column:
    """Regex rewrite of a URI prefix (X12); Java regex, ``$1`` for groups."""
    return F.regexp_replace(_c(c), pattern, replacement)


def uri_part(c: Column | str, part: str) -> Column:
    """PROTOCOL, HOST, PATH, QUERY, REF of a URI; null on a malformed one."""
    return F.try_parse_url(_c(c), F.lit(part))


def map_get_or(m: Column | str, key: str, default) -> Column:
    """Map lookup with a default for a missing key."""
    return F.coalesce(F.try_element_at(_c(m), F.lit(key)), F.lit(default))


def version_as_number(c: Column | str = "version") -> Column:
    """Version text to a number for ordering."""
    return _c(c).cast("long")


def improvement_ratio(ap: Column | str, prevalence: Column | str) -> Column:
    """AP over the random baseline (prevalence)."""
    return F.try_divide(_c(ap), _c(prevalence))
