"""Column functions: parsing, repair, keys, labels. All of them stay inside generated JVM code."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the placeholder that the public surrogate-key rule hashes for a null.
NULL_KEY_PLACEHOLDER = "_dbt_utils_surrogate_key_null_"


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def money(value: Column | str) -> Column:
    """Exact amount of a double that holds two digits, so that summation order never changes a digit.

    By way of whole cents: a direct cast from double to decimal goes through text and costs several
    times as much.
    """
    return cents(value).cast("decimal(12,0)") * F.expr("0.01bd")


def cents(value: Column | str) -> Column:
    return F.rint(as_col(value) * 100).cast("bigint")


def try_cast(value: Column | str, kind: str) -> Column:
    return as_col(value).try_cast(kind)


def json_field(payload: Column | str, path: str, kind: str = "string") -> Column:
    """Typed value at a JSON path; null when missing, malformed or not castable."""
    return try_cast(F.get_json_object(as_col(payload), path), kind)


def json_fields(payload: Column | str, fields: dict[str, tuple[str, str]]) -> list[Column]:
    """``{name: (path, type)}`` to aliased columns."""
    return [json_field(payload, path, kind).alias(name) for name, (path, kind) in fields.items()]


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(F.trim(as_col(value)), F.lit(""))


def to_timestamp_or_null(value: Column | str, fmt: str | None = None) -> Column:
    value = blank_to_null(value)
    if fmt is None:
        return try_cast(value, "timestamp_ntz")
    return F.try_to_timestamp(value, F.lit(fmt)).cast("timestamp_ntz")


def to_date_or_null(value: Column | str, fmt: str | None = None) -> Column:
    if fmt is None:
        return try_cast(blank_to_null(value), "date")
    return to_timestamp_or_null(value, fmt).cast("date")


def first_present(*values: Column | str) -> Column:
    return F.coalesce(*[as_col(v) for v in values])


def yes_no(condition: Column, yes: str = "Y", no: str = "N") -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def money_text(value: Column | str, symbol: str = "$") -> Column:
    """Currency text such as ``$1,234.50`` to ``decimal(10,2)``."""
    bare = F.replace(F.replace(as_col(value), F.lit(symbol), F.lit("")), F.lit(","), F.lit(""))
    return try_cast(bare, "decimal(10,2)")


def greatest_or_null(*values: Column | str) -> Column:
    """Greatest value, null as soon as one input is null (Spark's own ``greatest`` skips nulls)."""
    cols = [as_col(v) for v in values]
    all_present = cols[0].isNotNull()
    for col in cols[1:]:
        all_present = all_present & col.isNotNull()
    return F.when(all_present, F.greatest(*cols))


def utc_to_zone(ts: Column | str, zone: Column | str) -> Column:
    """Wall-clock time in a fixed zone (text) or in the zone a column names; input is UTC."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), zone, as_col(ts))


def zone_to_utc(ts: Column | str, zone: Column | str) -> Column:
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(zone, F.lit("UTC"), as_col(ts))


def date_key(value: Column | str) -> Column:
    return F.date_format(as_col(value), "yyyyMMdd").cast("int")


def hour_key(value: Column | str) -> Column:
    return F.date_format(as_col(value), "yyyyMMddHH")


def surrogate_key(*values: Column | str) -> Column:
    parts = [F.coalesce(as_col(v).cast("string"), F.lit(NULL_KEY_PLACEHOLDER)) for v in values]
    return F.md5(F.concat_ws("-", *parts))


def decode(value: Column | str, table: dict, default: str | None = None) -> Column:
    """Code table as a CASE chain."""
    chain = F
    for code, label in table.items():
        chain = chain.when(as_col(value) == F.lit(code), F.lit(label))
    return chain.otherwise(F.lit(default))


def band(value: Column | str, edges: Sequence[float], labels: Sequence[str], null_as_zero: bool = False):
    """Half-open bands ``(-inf, e0) [e0, e1) ... [en, inf)``: returns (label, sort key).

    A null falls out of every band unless ``null_as_zero`` asks for the report semantics in
    which a blank compares as zero.
    """
    if len(labels) != len(edges) + 1:
        raise ValueError("need one label more than edges")
    value = as_col(value)
    if null_as_zero:
        value = F.coalesce(value, F.lit(0))
    position, label = F, F
    for i, edge in enumerate(edges):
        position = position.when(value < F.lit(edge), F.lit(i + 1))
        label = label.when(value < F.lit(edge), F.lit(labels[i]))
    position = position.when(value.isNotNull(), F.lit(len(edges) + 1))
    return label.when(value.isNotNull(), F.lit(labels[-1])), position


def linear_score(value: Column | str, intercept: float, slope: float) -> Column:
    """Inverse of ``y = slope*x + intercept``, never below zero."""
    raw = (as_col(value) - F.lit(intercept)) / F.lit(slope)
    return F.when(raw < 0, F.lit(0.0)).otherwise(raw)


def upper_snake(name: str) -> str:
    """``orderKeyId`` -> ``ORDER_KEY_ID``; runs of other characters become one underscore."""
    name = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"[^A-Za-z0-9]+", "_", name).strip("_").upper()


def upper_snake_col(value: Column | str) -> Column:
    step = F.regexp_replace(as_col(value), "([a-z0-9])([A-Z])", "$1_$2")
    step = F.regexp_replace(step, "[^A-Za-z0-9]+", "_")
    return F.upper(F.trim(step, F.lit("_")))


def before(value: Column | str, marker: str) -> Column:
    value = as_col(value)
    return F.when(F.contains(value, F.lit(marker)), F.substring_index(value, marker, 1))


def after(value: Column | str, marker: str) -> Column:
    value = as_col(value)
    at = F.instr(value, marker)
    return F.when(at > 0, F.substr(value, at + F.lit(len(marker))))


def between_marks(value: Column | str, left: str, right: str) -> Column:
    """Text after the first ``left`` up to the next ``right``; null when a marker is missing."""
    return before(after(value, left), right)


def ordinal_date(value: Column | str) -> Column:
    """``1st September, 2020`` to a date."""
    plain = F.regexp_replace(as_col(value), "^([0-9]+)(st|nd|rd|th) ", "$1 ")
    return to_date_or_null(plain, "d MMMM, yyyy")


def first_token(value: Column | str, sep: str) -> Column:
    return F.split_part(as_col(value), F.lit(sep), F.lit(1))


def last_token(value: Column | str, sep: str) -> Column:
    return F.split_part(as_col(value), F.lit(sep), F.lit(-1))


def metric_text(value: Column | str, kind: str) -> Column:
    """Report text of a number: ``millions`` ($1.23M), ``percent`` (1.23%), ``units`` (1,234), ``price`` (1.23)."""
    value = as_col(value)
    if kind == "millions":
        return F.concat(F.lit("$"), F.format_number(value / 1e6, 2), F.lit("M"))
    if kind == "percent":
        return F.concat(F.format_number(value * 100, 2), F.lit("%"))
    if kind == "price":
        return F.format_number(value, 2)
    if kind == "units":
        return F.format_number(value, 0)
    raise ValueError(f"unknown number format {kind}")


def sign_colour(value: Column | str, good: str = "#107C10", bad: str = "#C50F1F", flat: str = "#605E5C") -> Column:
    """Colour of a change: up, exactly zero, and anything else; a missing value counts as bad."""
    value = as_col(value)
    return F.when(value > 0, F.lit(good)).when(value == 0, F.lit(flat)).otherwise(F.lit(bad))


def payload_bytes(value: Column | str, encoding: str = "text") -> Column:
    """Bytes a payload takes: half the digits when hex coded, else its UTF-8 length."""
    if encoding == "hex":
        return (F.length(as_col(value)) / 2).cast("bigint")
    return F.octet_length(as_col(value)).cast("bigint")


def mask_keep_last(value: Column | str, keep: int = 4, fill: str = "X") -> Column:
    """Hide all but the last ``keep`` characters; a value no longer than that is hidden whole."""
    value = as_col(value)
    size = F.length(value)
    hidden = F.concat(F.repeat(F.lit(fill), size - F.lit(keep)), F.right(value, F.lit(keep)))
    return F.when(size <= keep, F.repeat(F.lit(fill), size)).otherwise(hidden)


def role_mask(value: Column | str, role: Column | str, open_roles: Sequence[str], keep: int = 4) -> Column:
    role = F.lit(role) if isinstance(role, str) else role
    return F.when(role.isin(*open_roles), as_col(value)).otherwise(mask_keep_last(value, keep))


def whole_part(value: Column | str, size: int) -> Column:
    """Integer division, exact for every bigint."""
    return F.call_function("div", as_col(value), F.lit(size))


def safe_ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division, null on a zero or null base (plain ``/`` throws in ANSI mode)."""
    return F.try_divide(as_col(top).cast("double"), as_col(bottom).cast("double"))


def hash_number(*values: Column | str, salt: str = "") -> Column:
    """Repeatable non-negative number below 2**32 from the first eight md5 digits."""
    text = F.concat_ws("|", F.lit(salt), *[as_col(v).cast("string") for v in values])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
