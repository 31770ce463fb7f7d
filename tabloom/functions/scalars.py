"""Scalar expressions: parsing, repair, binning, rounding and small codings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import as_column


# ---- missing values -------------------------------------------------------
def missing_or(column: Column | str, condition: Column) -> Column:
    """True where the condition holds and also where the value is missing."""
    return as_column(column).isNull() | condition


def sentinel_to_null(column: Column | str, sentinel) -> Column:
    return F.nullif(as_column(column), F.lit(sentinel))


def nan_to_null(column: Column | str) -> Column:
    c = as_column(column)
    return F.when(~F.isnan(c), c)


# ---- parsing ----------------------------------------------------------------
def parse_int(text: Column | str) -> Column:
    """Whole number, or NULL when the text isn't one."""
    return as_column(text).try_cast("int")


def parse_number(text: Column | str) -> Column:
    """Number, or NULL when the text isn't one; the text 'nan' is missing too."""
    return nan_to_null(as_column(text).try_cast("double"))


def decimal_comma(text: Column | str) -> Column:
    """Number written with a decimal comma (or a point)."""
    return parse_number(F.translate(as_column(text), ",", "."))


# ---- codings ------------------------------------------------------------------
def recode(column: Column | str, mapping: Mapping) -> Column:
    """Replace the listed values and leave the others."""
    c = as_column(column)
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), c)


def flag(condition: Column) -> Column:
    return condition.cast("int")


def band(column: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval (edge, next edge]; NULL outside all of them."""
    c = as_column(column)
    out = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        inside = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(inside, F.lit(label)) if out is None else out.when(inside, F.lit(label))
    return out


def floor_bin(column: Column | str, width: int) -> Column:
    """Lower end of the fixed-width bin, e.g. age to decade."""
    return (F.floor(as_column(column) / F.lit(width)) * F.lit(width)).cast("long")


def clip_int(column: Column | str, low: float, high: float) -> Column:
    """Limit to a range, then cut off the fraction."""
    return F.least(F.greatest(as_column(column), F.lit(low)), F.lit(high)).cast("int")


# The wording of the point classes.
POINT_TEXT = {
    "origin": "origen",
    "y_axis": "eje Y en %s",
    "x_axis": "eje X en %s",
    "general": "punto (%s, %s)",
    "other": "no es un par de coordenadas",
}


def describe_point(x: Column | str, y: Column | str) -> Column:
    """Class of a pair of coordinates; a missing coordinate isn't a pair."""
    x, y = as_column(x), as_column(y)
    return (
        F.when(x.isNull() | y.isNull(), POINT_TEXT["other"])
        .when((x == 0) & (y == 0), POINT_TEXT["origin"])
        .when(x == 0, F.format_string(POINT_TEXT["y_axis"], y.cast("string")))
        .when(y == 0, F.format_string(POINT_TEXT["x_axis"], x.cast("string")))
        .otherwise(F.format_string(POINT_TEXT["general"], x.cast("string"), y.cast("string")))
    )


# ---- numbers --------------------------------------------------------------------
def close_to(a: Column | str, b: Column | str, rel: float = 1e-9, atol: float = 0.0) -> Column:
    """Equality of doubles within a relative (and optional absolute) tolerance."""
    a, b = as_column(a), as_column(b)
    return F.abs(a - b) <= F.greatest(F.lit(rel) * F.greatest(F.abs(a), F.abs(b)), F.lit(atol))


def logistic(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))


def bits(count: Column) -> Column:
    """Bits needed to single out one of `count` things."""
    return F.log2(count.cast("double"))


def round_even(column: Column | str, digits: int) -> Column:
    """Round half to even, as array libraries do; use F.round for SQL's half away from zero."""
    return F.bround(as_column(column), digits)


# ---- text -------------------------------------------------------------------------
def first_item(column: Column | str, sep: str = ";") -> Column:
    return F.trim(F.split_part(as_column(column), F.lit(sep), F.lit(1)))


def set_fingerprint(items: Column | str) -> Column:
    """Sixteen hex digits naming a set of strings: sorted, deduplicated, joined, SHA-256."""
    joined = F.concat_ws("|", F.array_sort(F.array_distinct(as_column(items))))
    return F.substr(F.sha2(joined, 256), F.lit(1), F.lit(16))


def is_mojibake(column: Column | str) -> Column:
    """Text whose Latin-1 bytes are valid UTF-8 holding a multi-byte character."""
    c = as_column(column)
    latin = F.coalesce(c.rlike("^[\\x{00}-\\x{FF}]*$") & c.rlike("[\\x{C2}-\\x{F4}]"), F.lit(False))
    # 'encode' raises on unmappable text, so only Latin-1 text ever reaches it
    raw = F.encode(F.when(latin, c), "ISO-8859-1").cast("string")
    return F.coalesce(latin & F.is_valid_utf8(raw), F.lit(False))


def repair_mojibake(column: Column | str) -> Column:
    """Undo one wrong UTF-8-as-Latin-1 reading; other text stays as it is."""
    c = as_column(column)
    broken = is_mojibake(c)
    return F.when(broken, F.encode(F.when(broken, c), "ISO-8859-1").cast("string")).otherwise(c)


def birth_date(reference: str, days: Column) -> Column:
    """Date that lies `days` before the reference date."""
    return F.date_sub(F.to_date(F.lit(reference)), days.cast("int"))
