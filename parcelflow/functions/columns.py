"""Scalar building blocks of the models, all JVM-side built-ins.

None of these is a Python UDF: each returns a ``Column`` expression, so it
stays inside whole-stage codegen and Catalyst can fold, push and prune it.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values (must equal the modelled behaviour) ----------------------
# First day of the date spine and lower bound of the violation fact.
SPINE_START = _dt.date(2005, 1, 1)
# Text hashed in place of NULL by the surrogate-key generator.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"
# Ordinance suffixes removed when unifying violation codes across eras.
CODE_SUFFIXES = ("C.O.", "c.o.")
# City bounding box (inclusive) used to clean geocodes.
LAT_RANGE = (38.8, 39.5)
LNG_RANGE = (-94.9, -94.3)
# Substrings (lower case) that mark a dangerous-building case as demolition.
DEMOLITION_WORDS = ("demolition", "demolish")
# -----------------------------------------------------------------------------

# ``as_of`` used by the test-table binding (stands in for CURRENT_DATE).
AS_OF_DEFAULT = _dt.date(2010, 6, 30)

# Characters TRIM removes: all ASCII whitespace, not only the space that
# Spark's one-argument trim strips.
WHITESPACE = " \t\n\r\f\u000b"
# Text a date cast accepts: year-month-day, month and day 1-2 digits.  \z, not
# $: the latter also matches before a final line break.
_DATE_TEXT = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"
# Text a number cast accepts: a decimal number with an optional exponent, white
# space around it.  Hex digits, digit separators, type suffixes and the words
# for NaN and infinity are not numbers here: a measure that is one is dirt.
NUMBER_TEXT = (r"[ \t\n\r\f\x0B]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
               r"[ \t\n\r\f\x0B]*")


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_as(type_name: str) -> Column:
    """Typed NULL literal (B2)."""
    return F.lit(None).cast(type_name)


def clean_trim(c: Column | str) -> Column:
    """TRIM that strips every leading/trailing whitespace character (H1)."""
    return F.trim(col_of(c), F.lit(WHITESPACE))


def safe_date(c: Column | str) -> Column:
    """First 10 characters cast to DATE, NULL when unparseable (H7, H8).

    ``try_cast`` alone accepts ``2022`` or ``2022-07``; the guard keeps the
    cast to full year-month-day text.
    """
    head = F.substring(col_of(c), 1, 10)
    return F.when(head.rlike(_DATE_TEXT), head.try_cast("date"))


def safe_double(c: Column | str) -> Column:
    """Text cast to DOUBLE, NULL when not a plain finite number (H9)."""
    c = col_of(c)
    d = F.when(c.rlike(rf"\A{NUMBER_TEXT}\z"), clean_trim(c).try_cast("double"))
    return F.when(F.abs(d) < float("inf"), d)


def point_coordinates(point: Column | str) -> Column:
    """The ``coordinates`` array of a JSON point text as texts (H10, I3); NULL
    when the text is not one object with such an array.  Parses the JSON once."""
    return whole_object(point, "struct<coordinates:array<string>>")["coordinates"]


def whole_object(text: Column | str, kind: str) -> Column:
    """The text as one JSON object of type ``kind``; NULL when it is none, or
    when anything but white space stands around it.

    The parser stops at the end of the first value and ignores what follows, so
    the text is put into an array with a mark behind it: whatever follows the
    object breaks the array, adds an element or hides the mark.  The parsed text is
    looked at inside a lambda: fields taken off it directly are each parsed apart.
    """
    parsed = F.from_json(F.concat(F.lit('{"value":['), col_of(text), F.lit('],"mark":true}')),
                         f"struct<value:array<{kind}>,mark:boolean>")
    whole = lambda around: F.when(
        around["mark"] & (F.size(around["value"]) == 1), around["value"][0])
    return F.transform(F.array(parsed), whole)[0]


def coord_at(coords: Column | str, index: int) -> Column:
    """Coordinate ``index`` (0 = lng, 1 = lat) of a parsed coordinates array."""
    return safe_double(F.try_element_at(col_of(coords), F.lit(index + 1)))


def normalize_code(c: Column | str) -> Column:
    """Unify an ordinance across eras: drop the suffixes, trim, blank→NULL."""
    out = col_of(c)
    for suffix in CODE_SUFFIXES:
        out = F.replace(out, F.lit(suffix), F.lit(""))
    return F.nullif(clean_trim(out), F.lit(""))


def days_between(start: Column | str, end: Column | str) -> Column:
    """Whole days from ``start`` to ``end``; NULL if either is NULL."""
    return F.datediff(col_of(end), col_of(start)).cast("bigint")


def surrogate_key(c: Column | str) -> Column:
    """Hex MD5 of the text form, with a fixed placeholder for NULL."""
    return F.md5(F.coalesce(col_of(c).cast("string"), F.lit(SURROGATE_NULL)))


def row_hash(cols: list[str]) -> Column:
    """Hex MD5 of the whole row rendered as JSON text (H12, H13): numbers and
    booleans bare, dates and texts quoted, NULL fields kept, so two different rows
    never share a text.
    """
    return F.md5(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}))


def lat_lng(lat: Column | str, lng: Column | str) -> Column:
    """``"lat,lng"`` label; NULL when either coordinate is NULL."""
    lat, lng = col_of(lat), col_of(lng)
    return F.concat(lat.cast("string"), F.lit(","), lng.cast("string"))


def in_bbox(lat: Column | str, lng: Column | str) -> Column:
    lat, lng = col_of(lat), col_of(lng)
    return lat.between(*LAT_RANGE) & lng.between(*LNG_RANGE)


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """num / den as DOUBLE, NULL when den is 0 or NULL."""
    return F.try_divide(col_of(num).cast("double"), col_of(den))


def year_of(c: Column | str) -> Column:
    return F.year(col_of(c)).cast("bigint")
