"""Column helpers: every function takes and returns a ``Column``."""

from parcelflow.functions.columns import (  # noqa: F401
    AS_OF_DEFAULT, SPINE_START, SURROGATE_NULL, WHITESPACE,
    clean_trim, col_of, coord_at, point_coordinates, days_between, in_bbox, lat_lng,
    normalize_code, null_as, row_hash, safe_date, safe_divide, safe_double,
    surrogate_key, year_of,
)
