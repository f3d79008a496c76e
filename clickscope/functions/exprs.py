"""Scalar functions as built-in Column expressions (never Python UDFs).

Each function returns a ``Column`` so it stays inside whole-stage codegen and
does not block predicate pushdown.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "col_of", "between_or_true", "in_any", "equal_or_true", "csv_overlap",
    "visit_bucket", "step_bucket", "VISIT_BUCKETS", "STEP_BUCKETS", "half_up_ratio", "raw_ratio",
    "parse_time", "parse_date_key", "today", "yesterday", "is_not_empty", "format_time", "format_date", "format_date_key", "format_minute", "date_hour",
    "seconds_between", "int_div", "is_empty", "trim_comma", "pad2", "kv_get", "kv_set", "json_field",
    "concat_long_string", "group_concat_distinct", "csv_to_longs", "before", "after",
    "area_level", "product_status",
]

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Bucket labels of the session statistics, in report order.
VISIT_BUCKETS = ["1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m", "10m_30m", "30m"]
STEP_BUCKETS = ["1_3", "4_6", "7_9", "10_30", "30_60", "60"]

# Area -> level mapping of the area report.
AREA_LEVELS = {
    "A_Level": ["华北", "华东"],
    "B_Level": ["华中", "华南"],
    "C_Level": ["西南", "西北"],
}
DEFAULT_AREA_LEVEL = "D_Level"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- predicates (FLT1-FLT3) --------------------------------------------------

# The predicates below are filter conditions: a null data value yields null,
# which ``where`` treats as false.  They are left as plain comparisons (no
# ``coalesce`` wrapper) so Spark can push them into the Parquet scan.

def between_or_true(c, low, high) -> Column:
    """Inclusive range test; no predicate when either bound is missing;
    a null data value does not pass."""
    if low is None or high is None:
        return F.lit(True)
    return col_of(c).between(F.lit(low), F.lit(high))


def in_any(c, values: Sequence[str] | None) -> Column:
    """Single-valued field is one of ``values``; true when no values given;
    null and the ``-1`` sentinel do not pass."""
    if not values:
        return F.lit(True)
    vals = [v for v in values if str(v) != "-1"]
    if not vals:
        return F.lit(False)
    return col_of(c).cast("string").isin(vals)


def csv_overlap(c, values: Sequence[str] | None) -> Column:
    """A csv field shares at least one whole item with ``values``
    (exact match per item, so 12 does not match 112); null or ``-1`` do not pass."""
    if not values:
        return F.lit(True)
    x = col_of(c).cast("string")
    items = F.split(x, ",")
    param = F.array(*[F.lit(str(v)) for v in values])
    return (x != "-1") & F.arrays_overlap(items, param)


def equal_or_true(c, value) -> Column:
    """Equality with ``value``; true when no value given; null does not pass."""
    if value is None or value == "":
        return F.lit(True)
    return col_of(c).cast("string") == F.lit(str(value))


# --- bucket labels (PRJ3) ---------------------------------------------------

def visit_bucket(seconds) -> Column:
    s = col_of(seconds)
    return (F.when((s >= 1) & (s <= 3), "1s_3s")
            .when((s >= 4) & (s <= 6), "4s_6s")
            .when((s >= 7) & (s <= 9), "7s_9s")
            .when((s >= 10) & (s <= 30), "10s_30s")
            .when((s > 30) & (s <= 60), "30s_60s")
            .when((s > 60) & (s <= 180), "1m_3m")
            .when((s > 180) & (s <= 600), "3m_10m")
            .when((s > 600) & (s <= 1800), "10m_30m")
            .when(s > 1800, "30m"))


def step_bucket(steps) -> Column:
    s = col_of(steps)
    return (F.when((s >= 1) & (s <= 3), "1_3")
            .when((s >= 4) & (s <= 6), "4_6")
            .when((s >= 7) & (s <= 9), "7_9")
            .when((s >= 10) & (s <= 30), "10_30")
            .when((s > 30) & (s <= 60), "30_60")
            .when(s > 60, "60"))


# --- ratios (FN7) -----------------------------------------------------------

def half_up_ratio(num: str, den: str, scale: int = 2) -> Column:
    """``num / den`` rounded HALF_UP to ``scale`` digits, computed exactly in
    integer arithmetic: ``((2 * 10^s * n + d) div (2 d)) / 10^s``.

    ``num`` and ``den`` are SQL expressions (column names or aggregates).
    Null when the denominator is 0 or null."""
    p = 10 ** scale
    n = f"CAST(({num}) AS BIGINT)"
    d = f"CAST(({den}) AS BIGINT)"
    return F.expr(f"CASE WHEN {d} <> 0 THEN CAST(({n} * {2 * p} + {d}) div (2 * {d}) AS DOUBLE) / {p} END")


def round_half_up(c, scale: int = 0) -> Column:
    """FN7: a number rounded HALF_UP to ``scale`` digits (from its shortest decimal form)."""
    return F.round(col_of(c).cast("double"), scale)


def int_div(a, b) -> Column:
    """Exact integer division of non-negative columns (``a div b``) for operands
    that may be sub-query columns: ``(a - a % b) / b`` is an exact quotient."""
    a, b = col_of(a).cast("bigint"), col_of(b).cast("bigint")
    return ((a - a % b) / b).cast("bigint")


def raw_ratio(num, den) -> Column:
    """Unrounded double ratio; null when the denominator is 0."""
    return F.try_divide(col_of(num).cast("double"), F.nullif(col_of(den).cast("double"), F.lit(0.0)))


# --- dates and times (FN1-FN6, FN18) ---------------------------------------

def parse_time(c) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> timestamp; null when malformed."""
    return F.try_to_timestamp(col_of(c), F.lit(TIME_FORMAT))


def parse_date_key(c) -> Column:
    """``yyyyMMdd`` text -> date; null when malformed."""
    return F.try_to_date(col_of(c), "yyyyMMdd")


def today() -> Column:
    """FN4: today's date as ``yyyy-MM-dd`` (session time zone)."""
    return F.date_format(F.current_date(), "yyyy-MM-dd")


def yesterday() -> Column:
    return F.date_format(F.date_sub(F.current_date(), 1), "yyyy-MM-dd")


def format_time(c) -> Column:
    return F.date_format(col_of(c), TIME_FORMAT)


def format_date(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM-dd")


def format_date_key(c) -> Column:
    return F.date_format(col_of(c), "yyyyMMdd")


def format_minute(c) -> Column:
    return F.date_format(col_of(c), "yyyyMMddHHmm")


def date_hour(c) -> Column:
    return F.date_format(col_of(c), "yyyy-MM-dd_HH")


def seconds_between(start, end) -> Column:
    """Whole seconds from ``start`` to ``end`` (FN2, ``end - start``)."""
    return F.timestamp_diff("SECOND", col_of(start), col_of(end))


def before(a, b) -> Column:
    return col_of(a) < col_of(b)


def after(a, b) -> Column:
    return col_of(a) > col_of(b)


# --- strings (FN8-FN12, FN14, FN16) ----------------------------------------

def is_empty(c) -> Column:
    return F.coalesce(col_of(c), F.lit("")) == ""


def is_not_empty(c) -> Column:
    return F.coalesce(col_of(c), F.lit("")) != ""


def trim_comma(c) -> Column:
    return F.regexp_replace(col_of(c), r"^,+|,+$", "")


def pad2(c) -> Column:
    """FN10: text of two characters as it is, any other behind one ``0``."""
    s = col_of(c).cast("string")
    return F.when(F.length(s) == 2, s).otherwise(F.concat(F.lit("0"), s))


def _quoted(delimiter: str) -> str:
    """A delimiter of any length as a literal regular expression."""
    return "".join("\\" + ch if ch in "|.^$*+?()[]{}\\" else ch for ch in delimiter)


def kv_get(c, field: str, delimiter: str = "|") -> Column:
    """Value of ``field`` in a ``k=v<delim>k=v`` string: the first pair whose key
    matches and that splits into exactly a key and a value, where trailing
    ``=`` are ignored as a Java ``split`` ignores trailing empty parts
    (``k=`` has no value, ``k=v=`` has value ``v``, ``k=a=b`` is skipped)."""
    pairs = F.split(col_of(c), _quoted(delimiter))
    kv = F.transform(pairs, lambda p: F.split(F.regexp_replace(p, "=+$", ""), "="))
    ok = F.filter(kv, lambda a: (F.size(a) == 2) & (a[0] == F.lit(field)))
    return F.try_element_at(ok, F.lit(1))[1]


def kv_set(c, field: str, value, delimiter: str = "|") -> Column:
    """Replace the value of ``field`` in a ``k=v`` string, keeping pair order."""
    pairs = F.split(col_of(c), _quoted(delimiter))
    v = value if isinstance(value, Column) else F.lit(str(value))
    new = F.transform(pairs, lambda p: F.when(F.split(p, "=")[0] == F.lit(field),
                                              F.concat(F.lit(field + "="), v)).otherwise(p))
    return F.array_join(new, delimiter)


def json_field(c, field: str) -> Column:
    """``get_json_field``: one top-level field of a JSON string, as text; a dot in
    the name is part of the name."""
    if set(field) & set("'?"):  # characters that a JSON path cannot hold
        return F.try_element_at(F.from_json(col_of(c), "map<string,string>"), F.lit(field))
    return F.get_json_object(col_of(c), f"$['{field}']")


def concat_long_string(v1, v2, sep: str = ":") -> Column:
    """``concat_long_string``: ``id + sep + text``."""
    return F.concat(col_of(v1).cast("string"), F.lit(sep), col_of(v2).cast("string"))


def group_concat_distinct(c, sep: str = ",") -> Column:
    """Aggregate: distinct values, sorted, joined by ``sep``.

    Built on ``collect_set`` so Spark aggregates partially on the map side; the
    set only grows with the number of distinct values, not with rows."""
    return F.array_join(F.array_sort(F.collect_set(col_of(c))), sep)


def csv_to_longs(c) -> Column:
    """``"1,2,2"`` -> ``[1, 2, 2]``; non-numeric items are dropped."""
    items = F.transform(F.split(col_of(c), ","), lambda s: s.try_cast("bigint"))
    return F.filter(items, lambda x: x.isNotNull())


# --- labels (PRJ1, PRJ2) ------------------------------------------------------

def area_level(c) -> Column:
    a = col_of(c)
    expr = None
    for level, areas in AREA_LEVELS.items():
        cond = a.isin(areas)
        expr = F.when(cond, level) if expr is None else expr.when(cond, level)
    return expr.otherwise(DEFAULT_AREA_LEVEL)


def product_status(extend_info) -> Column:
    status = json_field(extend_info, "product_status")
    return F.when(status == "0", "Self").otherwise("Third Party")
