"""Scalar helpers. Every helper is a plain Column expression, so it stays in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_chars(c: Column, chars: str | Column) -> Column:
    """Delete every character of the set ``chars`` (a set, not a substring)."""
    chars = chars if isinstance(chars, Column) else F.lit(chars)
    return F.call_function("translate", c, chars, F.lit(""))


def is_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) == ""


def has_text(c: Column) -> Column:
    """Neither NULL nor the empty string."""
    return F.coalesce(c, F.lit("")) != ""


def starts_with_any(c: Column, prefixes: Iterable[str]) -> Column:
    result = F.lit(False)
    for p in prefixes:
        result = result | c.startswith(p)
    return result


def minute_boundaries(start: Column, end: Column) -> Column:
    """Minute boundaries crossed between two timestamps.

    10:00:59 to 11:01:00 crosses 61 boundaries although only 60 full minutes elapse.
    """
    clock = lambda t: F.hour(t) * 60 + F.minute(t)
    return F.datediff(F.to_date(end), F.to_date(start)) * 1440 + clock(end) - clock(start)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(F.to_date(later), F.to_date(earlier))


def date_key(d: Column) -> Column:
    return F.date_format(d, "yyyyMMdd")


def two_digit_year(fiscal_label: Column) -> Column:
    """``FY24`` to 2024."""
    return F.concat(F.lit("20"), F.substring(fiscal_label, 3, 2)).try_cast("int")


def clean_control(c: Column) -> Column:
    return F.regexp_replace(c, r"\p{Cntrl}", " ")


def valid_media_id(c: Column) -> Column:
    # Fixed value: the form of a media id.
    return c.rlike(r"^[A-Za-z0-9+/=]{32,}$")


def is_external_id(c: Column) -> Column:
    """Ids of customers, as opposed to staff and bots. The prefixes."""
    return starts_with_any(c, ("wo", "wm")) & ~c.startswith("wb")


def json_fields(text: Column) -> Column:
    """Top-level fields of a JSON object as ``map<string,string>``; a JSON null reads 'null'.

    Nested values keep their JSON text. NULL when the text is no JSON object.
    """
    return F.transform_values(F.from_json(text, "map<string,string>"), lambda _, v: F.coalesce(v, F.lit("null")))


def json_text(fields: Column, key: str | Column) -> Column:
    """A field out of ``json_fields``, '' if missing."""
    return F.coalesce(F.try_element_at(fields, key if isinstance(key, Column) else F.lit(key)), F.lit(""))


def guard_payload(payload: Column, msgtype: Column, max_chars: int | None = None) -> Column:
    """The payload whole; with ``max_chars``, longer chat records become an empty object."""
    if max_chars is None:
        return payload
    too_long = (msgtype == "chatrecord") & (F.length(payload) > max_chars)
    return F.when(too_long, F.lit("{}")).otherwise(payload)


def epoch_millis_text(millis: Column, zone: str = "Asia/Shanghai") -> Column:
    """Epoch milliseconds as local ``yyyy-MM-dd HH:mm:ss`` text, whatever the session zone.

    The zone offset is read from the instant in UTC and applied on a zone-free timestamp.
    """
    wall = F.convert_timezone(
        F.lit("UTC"), F.lit(zone), F.timestamp_add("SECOND", F.floor(millis / 1000), F.lit("1970-01-01").cast("timestamp_ntz"))
    )
    return F.date_format(wall, "yyyy-MM-dd HH:mm:ss")


def safe_div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def money(c: Column, precision: int = 15, scale: int = 2) -> Column:
    return c.cast(f"decimal({precision},{scale})")


def round_half_up(c: Column, scale: int = 2) -> Column:
    """Round away from zero at ties.

    A quotient of doubles is read to eight places first, so ties such as 1.005 and 3580.74 / 36 count as ties although their
    binary values do not.
    """
    return F.round(c.cast("decimal(30,8)"), scale).cast(f"decimal(18,{scale})")
