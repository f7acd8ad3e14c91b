"""DuckDB SQL for every registered query: the independent correctness oracle.

its own, with other operators than the Spark models use: windows and QUALIFY
where those aggregate, full joins where those add and append, a lookup per
measure where those join aggregates.  ``sql_for(name)`` emits a single ``WITH`` statement holding
the model and everything it reads.  This module only assembles SQL text for
the checker; it plans and executes nothing.
"""

from __future__ import annotations

from parcelflow.functions.columns import AS_OF_DEFAULT, SPINE_START, SURROGATE_NULL
from parcelflow.plans import faults
from parcelflow.sources.seeds import VIOLATION_LABELS
from parcelflow.sources.testdata import DATE_SHIFT_DAYS

AS_OF = f"DATE '{AS_OF_DEFAULT.isoformat()}'"
START = f"DATE '{SPINE_START.isoformat()}'"
_WS = "' ' || chr(9) || chr(10) || chr(13) || chr(12) || chr(11)"


def trim_ws(x: str) -> str:
    return f"trim({x}, {_WS})"


def to_date(x: str) -> str:
    h = f"substr({x}, 1, 10)"
    return (f"CASE WHEN regexp_full_match({h}, '[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}') "
            f"THEN TRY_CAST({h} AS DATE) END")


# A plain decimal number with an optional exponent, white space around it.
_NUMBER = r"[ \t\n\r\f\v]*[-+]?(\d+\.?\d*|\.\d+)([eE][-+]?\d+)?[ \t\n\r\f\v]*"


def to_double(x: str) -> str:
    number = (f"CASE WHEN regexp_full_match({x}, '{_NUMBER}') "
              f"THEN TRY_CAST({trim_ws(x)} AS DOUBLE) END")
    return f"CASE WHEN isfinite({number}) THEN {number} END"


def point_coord(x: str, i: int) -> str:
    return to_double(f"CASE WHEN json_valid({x}) THEN json_extract_string({x}, '$.coordinates[{i}]') END")


def norm_code(x: str) -> str:
    return f"NULLIF({trim_ws(f'replace(replace({x}, {chr(39)}C.O.{chr(39)}, {chr(39)}{chr(39)}), {chr(39)}c.o.{chr(39)}, {chr(39)}{chr(39)})')}, '')"


def sk(x: str) -> str:
    return f"md5(coalesce(CAST({x} AS VARCHAR), '{SURROGATE_NULL}'))"


def iso(date_expr: str) -> str:
    return f"strftime({date_expr}, '%Y-%m-%d') || 'T00:00:00.000'"


def div(a: str, b: str) -> str:
    return f"CAST({a} AS DOUBLE) / NULLIF({b}, 0)"


_LABEL_VALUES = ", ".join(
    "('{}', '{}')".format(code.replace("'", "''"), label.replace("'", "''"))
    for code, label in VIOLATION_LABELS)

HISTORY_COLS = ["violation_id", "case_number", "pin", "source_system", "street_address",
                "full_address", "zip_code", "council_district", "neighborhood", "latitude",
                "longitude", "chapter", "ordinance", "violation_code",
                "violation_description", "date_found", "date_to_comply", "status_raw",
                "date_resolved", "is_resolved", "days_open"]

# name -> (dependencies, SELECT body)
MODELS: dict[str, tuple[list[str], str]] = {}


def model(name: str, deps: list[str], body: str) -> None:
    MODELS[name] = (deps, body)


# ---- binding of the given tables to the raw feeds ---------------------------
model("base_raw", [], """
SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_returnflag,
       l.l_linestatus, l.l_shipdate, o.o_custkey, o.o_orderstatus, o.o_orderdate,
       c.c_name, c.c_mktsegment, n.n_name, n.n_regionkey, p.p_brand, p.p_type, p.p_size
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN part p ON l.l_partkey = p.p_partkey""")

model("vbase", ["base_raw"], f"""
SELECT *,
  CAST(l_orderkey AS VARCHAR) AS k_txt,
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS vid,
  (l_partkey % 97 = 0) AS blank_pin,
  '39.' || lpad(CAST((l_orderkey * 7) % 1000 AS VARCHAR), 3, '0') AS lat_txt,
  '-94.' || lpad(CAST(l_orderkey % 1000 AS VARCHAR), 3, '0') AS lng_txt,
  CASE WHEN l_suppkey % 41 = 0 THEN 'n/a'
       ELSE {iso(f'CAST(l_shipdate AS DATE) + {DATE_SHIFT_DAYS}')} END AS found_txt,
  {iso(f'CAST(o_orderdate AS DATE) + {DATE_SHIFT_DAYS}')} AS ordered_txt,
  CASE WHEN o_custkey % 31 = 0 THEN NULL WHEN o_custkey % 29 = 0 THEN ' '
       ELSE CAST(n_regionkey + 1 AS VARCHAR) END AS district_txt,
  c_name || ', ' || n_name AS full_addr
FROM (SELECT * FROM base_raw UNION ALL SELECT * FROM base_raw WHERE l_orderkey % 50 = 0)""")

model("npd_violations", ["vbase"], f"""
SELECT vid AS violationid, k_txt AS casenumber,
  CASE WHEN blank_pin THEN '' ELSE ' ' || k_txt || '  ' END AS pin,
  c_name AS street_address, full_addr AS full_address, c_mktsegment AS postalcode,
  district_txt AS computed_region_9t2m_phkm,
  CASE WHEN l_suppkey % 43 = 0 THEN '{{"type":"Point","coordinates":[]}}'
       WHEN l_suppkey % 47 = 0 THEN NULL
       ELSE '{{"type":"Point","coordinates":[' || lng_txt || ',' || lat_txt || ']}}' END
    AS incident_location,
  CAST(p_size AS VARCHAR) AS chapter, p_brand AS ordinance, p_type AS description,
  found_txt AS date_found,
  {iso(f'CAST(l_shipdate AS DATE) + {DATE_SHIFT_DAYS + 30}')} AS date_to_comply,
  ordered_txt AS date_resolved,
  CASE l_returnflag WHEN 'R' THEN 'Closed' WHEN 'A' THEN 'Open' END AS vio_status,
  CASE WHEN o_orderstatus = 'F' THEN 'Closed' ELSE 'Open' END AS case_status
FROM vbase WHERE l_linestatus = 'O'""")

model("historical_violations", ["vbase"], """
SELECT vid AS id, k_txt AS case_id,
  CASE WHEN blank_pin THEN '' ELSE chr(9) || k_txt || chr(10) END AS pin,
  c_name AS address, c_mktsegment AS zip_code,
  district_txt || ' ' AS council_district, n_name AS neighborhood,
  CASE WHEN l_suppkey % 53 = 0 THEN '0' WHEN l_suppkey % 59 = 0 THEN 'unknown'
       ELSE lat_txt END AS latitude,
  CASE WHEN l_suppkey % 53 = 0 THEN '0' ELSE lng_txt END AS longitude,
  CAST(p_size AS VARCHAR) AS chapter,
  p_brand || CASE WHEN l_linenumber = 7 THEN ' c.o.' ELSE ' C.O.' END AS ordinance,
  p_type AS violation_description,
  found_txt AS violation_entry_date, ordered_txt AS case_opened,
  CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE ordered_txt END AS case_closed,
  CASE l_returnflag WHEN 'R' THEN 'Closed' WHEN 'A' THEN 'CLOSED' ELSE 'Open' END AS status
FROM vbase WHERE l_linestatus = 'F'""")

model("dbase", [], f"""
SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_orderdate, c.c_name,
       c.c_mktsegment, n.n_name, n.n_regionkey, 1 AS listing
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderpriority = '1-URGENT'""")

model("dangerous_buildings", ["dbase"], f"""
SELECT ' ' || CAST(o_orderkey AS VARCHAR) AS pin,
  CASE WHEN listing = 1 THEN 'DB' || CAST(o_orderkey AS VARCHAR)
       ELSE 'DB' || CAST(o_orderkey AS VARCHAR) || '-R' END AS casenumber,
  c_name AS address, c_name || ', ' || n_name AS location, c_mktsegment AS zip_code,
  CAST(n_regionkey + 1 AS VARCHAR) AS council_district,
  '{{"type":"Point","coordinates":[' || '-94.' || lpad(CAST(o_orderkey % 1000 AS VARCHAR), 3, '0')
    || ',' || '39.' || lpad(CAST((o_orderkey * 7) % 1000 AS VARCHAR), 3, '0') || ']}}'
    AS case_location,
  {iso(f'(CASE WHEN listing = 1 OR o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) ELSE CAST(o_orderdate AS DATE) - 365 END) + {DATE_SHIFT_DAYS}')}
    AS case_opened,
  CASE WHEN listing <> 1 THEN 'To DEMOLISH'
       WHEN o_orderstatus = 'P' THEN 'Pending demolition'
       WHEN o_orderstatus = 'F' THEN 'Closed - repaired'
       ELSE 'Open' END AS statusofcase
FROM (SELECT * FROM dbase UNION ALL SELECT * REPLACE (2 AS listing) FROM dbase
      WHERE o_custkey % 3 = 0)""")

model("violation_labels", [], f"""
SELECT * FROM (VALUES {_LABEL_VALUES}) t(violation_code, short_label)
UNION ALL
SELECT p_brand, 'Brand ' || substr(p_brand, 7, 10)
FROM (SELECT DISTINCT p_brand FROM part)
WHERE TRY_CAST(substr(p_brand, 7, 10) AS INTEGER) % 2 = 1""")

# ---- staging: output column -> expression over the raw text ------------------
def _project(columns: dict[str, str], source: str, where: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {c}" for c, e in columns.items()) + \
        f" FROM {source} WHERE {where}"


_CURRENT = dict(
    violation_id="violationid::VARCHAR", case_number="casenumber::VARCHAR", pin=trim_ws("pin"),
    source_system="'energov'", street_address="street_address", full_address="full_address",
    zip_code="postalcode", council_district=trim_ws("computed_region_9t2m_phkm"),
    neighborhood="NULL::VARCHAR", latitude=point_coord("incident_location", 1),
    longitude=point_coord("incident_location", 0), chapter="chapter", ordinance="ordinance",
    violation_code=norm_code("ordinance"), violation_description="description",
    date_found=to_date("date_found"), date_to_comply=to_date("date_to_comply"),
    date_resolved=to_date("date_resolved"), status_raw="ifnull(vio_status, case_status)",
    is_resolved=f"{to_date('date_resolved')} IS NOT NULL")
model("stg_violations_current", ["npd_violations"],
      _project(_CURRENT, "npd_violations", "violationid IS NOT NULL"))

_ARCHIVE = _CURRENT | dict(
    violation_id="id::VARCHAR", case_number="case_id::VARCHAR", source_system="'historical'",
    street_address="address", full_address="address", zip_code="zip_code",
    council_district=trim_ws("council_district"), neighborhood="neighborhood",
    latitude=to_double("latitude"), longitude=to_double("longitude"),
    violation_description="violation_description",
    date_found=f"ifnull({to_date('violation_entry_date')}, {to_date('case_opened')})",
    date_to_comply="NULL::DATE", date_resolved=to_date("case_closed"), status_raw="status",
    is_resolved=f"{to_date('case_closed')} IS NOT NULL OR lower(status) = 'closed'")
model("stg_violations_historical", ["historical_violations"],
      _project(_ARCHIVE, "historical_violations", "id IS NOT NULL"))

_LISTING = dict(
    pin=trim_ws("pin"), case_number="casenumber::VARCHAR", street_address="address",
    full_address="location", zip_code="zip_code", council_district=trim_ws("council_district"),
    neighborhood="NULL::VARCHAR", latitude=point_coord("case_location", 1),
    longitude=point_coord("case_location", 0), case_opened=to_date("case_opened"),
    status_of_case="statusofcase",
    is_demolition_status="regexp_matches(statusofcase, '(?i)demoli(tion|sh)')")
_NEWEST = ", ".join(f"x.{c} DESC NULLS LAST" for c in (
    "case_opened", "case_number", "street_address", "full_address", "zip_code",
    "council_district", "latitude", "longitude", "status_of_case"))
model("stg_dangerous_buildings", ["dangerous_buildings"], f"""
SELECT x.* FROM ({_project(_LISTING, 'dangerous_buildings', f"length({trim_ws('pin')}) > 0")}) x
QUALIFY row_number() OVER (PARTITION BY x.pin ORDER BY {_NEWEST}) = 1""")

# ---- intermediate ---------------------------------------------------------------
_HISTORY = ", ".join(
    {"date_resolved": "if(date_resolved >= date_found, date_resolved, NULL) AS date_resolved",
     "is_resolved": "date_resolved IS NOT NULL AND date_resolved >= date_found AS is_resolved",
     "days_open": f"date_diff('day', date_found, ifnull(if(date_resolved >= date_found, "
                  f"date_resolved, NULL), {AS_OF})) AS days_open"}.get(c, c)
    for c in HISTORY_COLS)
model("int_violations_unioned", ["stg_violations_current", "stg_violations_historical"],
      f"SELECT {_HISTORY} FROM (FROM stg_violations_historical UNION ALL BY NAME "
      "FROM stg_violations_current)")

# One scan: every measure as a window over the pin, the most recent row of each kept.
_RECENT = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "date_found", "source_system", "violation_id", "street_address", "full_address", "zip_code",
    "council_district", "latitude", "longitude"))
model("int_property_rollup", ["int_violations_unioned"], f"""
SELECT pin, min(date_found) OVER w AS first_violation_date,
  max(date_found) OVER w AS last_violation_date, count(*) OVER w AS total_violations,
  count(DISTINCT violation_code) OVER w AS distinct_violation_types,
  count(*) FILTER (is_resolved) OVER w AS resolved_violations,
  avg(days_open) OVER w AS avg_days_open, street_address, full_address, zip_code,
  council_district, max(neighborhood) OVER w AS neighborhood, latitude, longitude
FROM int_violations_unioned WHERE length(pin) > 0
WINDOW w AS (PARTITION BY pin)
QUALIFY row_number() OVER (PARTITION BY pin ORDER BY {_RECENT}) = 1""")

model("int_dangerous_building_by_pin", ["stg_dangerous_buildings"], """
SELECT pin, case_opened AS dangerous_building_date, status_of_case, is_demolition_status
FROM stg_dangerous_buildings""")

# ---- dimensions -----------------------------------------------------------------
# Cited and listed properties meet in one full join; the list speaks for a
# property only where the history does not know it.
_TAKEN = ", ".join(f"if(r.pin IS NOT NULL, r.{c}, d.{c}) AS {c}" for c in (
    "street_address", "full_address", "zip_code", "council_district", "neighborhood",
    "latitude", "longitude"))
model("dim_property", ["int_property_rollup", "stg_dangerous_buildings"], f"""
SELECT {sk('pin')} AS property_sk, m.* REPLACE (
    if(in_city, latitude, NULL) AS latitude, if(in_city, longitude, NULL) AS longitude)
FROM (SELECT ifnull(r.pin, d.pin) AS pin, {_TAKEN}
      FROM int_property_rollup r FULL JOIN stg_dangerous_buildings d ON r.pin = d.pin
      UNION VALUES ('UNKNOWN', NULL, NULL, NULL, 'UNKNOWN', NULL, NULL, NULL)) m,
  LATERAL (SELECT latitude >= 38.8 AND latitude <= 39.5
           AND longitude >= -94.9 AND longitude <= -94.3 AS in_city)""")

model("dim_council_district", ["int_violations_unioned"], f"""
SELECT {sk('name')} AS council_district_sk, name AS council_district,
  if(name = 'UNKNOWN', 'Unknown', concat('District ', name)) AS district_label
FROM (SELECT unnest(list_distinct(list_append(
        list(council_district) FILTER (length(council_district) > 0), 'UNKNOWN'))) AS name
      FROM int_violations_unioned)""")

model("dim_violation_type", ["int_violations_unioned", "violation_labels"], f"""
SELECT {sk('code')} AS violation_type_sk, code AS violation_code, chapter,
  violation_description, ifnull(short_label, code) AS short_label
FROM (SELECT DISTINCT ON (violation_code) violation_code AS code, chapter, violation_description
      FROM int_violations_unioned WHERE violation_code IS NOT NULL
      ORDER BY violation_code, violation_description NULLS FIRST, chapter NULLS FIRST)
  LEFT JOIN violation_labels l ON l.violation_code = code
UNION ALL
SELECT {sk("'UNKNOWN'")}, 'UNKNOWN', NULL, 'Unknown / uncoded',
  ifnull((SELECT any_value(short_label) FROM violation_labels WHERE violation_code = 'UNKNOWN'),
         'UNKNOWN')""")

model("dim_date", [], f"""
SELECT {sk('day')} AS date_sk, day AS date_day, date_part('year', day)::BIGINT AS year,
  date_part('quarter', day)::BIGINT AS quarter, date_part('month', day)::BIGINT AS month,
  strftime(day, '%B') AS month_name
FROM (SELECT unnest(range({START}::TIMESTAMP, ({AS_OF} + 1)::TIMESTAMP, INTERVAL 1 DAY))::DATE
      AS day)""")

# ---- facts ----------------------------------------------------------------------
_or_unknown = "if(length({0}) > 0, {0}, 'UNKNOWN')".format
_row_json = "to_json({" + ", ".join(f"'{c}': {c}" for c in HISTORY_COLS) + "})"
model("fact_violation", ["int_violations_unioned"], f"""
SELECT DISTINCT md5({_row_json}) AS violation_pk, {sk(_or_unknown('pin'))} AS property_sk,
  {sk("ifnull(violation_code, 'UNKNOWN')")} AS violation_type_sk,
  {sk(_or_unknown('council_district'))} AS council_district_sk, {sk('date_found')} AS date_sk,
  violation_id, source_system, date_found, date_resolved, days_open, is_resolved
FROM int_violations_unioned WHERE date_found BETWEEN {START} AND {AS_OF}""")

# The stage is the furthest milestone a property has reached.
model("fact_property_lifecycle", ["int_property_rollup", "int_dangerous_building_by_pin"], f"""
SELECT {sk('pin')} AS property_sk, {sk(_or_unknown('council_district'))} AS council_district_sk,
  pin, first_violation_date, last_violation_date, total_violations, distinct_violation_types,
  resolved_violations, avg_days_open, listed AS ever_dangerous_building,
  dangerous_building_date, razed AS is_demolition_status,
  date_diff('day', first_violation_date, dangerous_building_date)
    AS days_first_violation_to_dangerous,
  ['single_violation', 'repeat_violations', 'dangerous_building', 'demolition'][
    1 + greatest(if(total_violations >= 2, 1, 0), if(listed, 2, 0), if(razed, 3, 0))]
    AS current_stage
FROM (SELECT r.*, b.dangerous_building_date, b.pin IS NOT NULL AS listed,
        b.is_demolition_status IS TRUE AS razed
      FROM int_property_rollup r LEFT JOIN int_dangerous_building_by_pin b ON b.pin = r.pin)""")

# ---- marts ------------------------------------------------------------------------
model("mart_blight_funnel", ["fact_property_lifecycle"], f"""
SELECT i AS stage_order,
  ['Any violation', 'Repeat violations', 'Dangerous building', 'Demolition'][i] AS stage,
  n[i] AS property_count, if(i = 1, 1.0::DOUBLE, {div('n[i]', 'n[1]')})
    AS pct_of_violation_properties
FROM (SELECT unnest(range(1, 5)) AS i, n FROM (
  SELECT [count(*), count_if(total_violations >= 2)::BIGINT,
          count_if(ever_dangerous_building)::BIGINT, count_if(is_demolition_status)::BIGINT] AS n
  FROM fact_property_lifecycle))""")

_WORST = """(SELECT * FROM fact_property_lifecycle
  QUALIFY row_number() OVER (ORDER BY total_violations DESC, pin) <= {n})"""
model("mart_blight_hotspots", ["fact_property_lifecycle", "dim_property"], f"""
SELECT pin, street_address, council_district, neighborhood, latitude, longitude,
  total_violations, ever_dangerous_building, current_stage
FROM {_WORST.format(n=200)} JOIN dim_property USING (property_sk, pin)""")

model("adhoc_repeat_offenders", ["fact_property_lifecycle", "dim_property"], f"""
SELECT pin, street_address, council_district, total_violations, current_stage,
  ever_dangerous_building
FROM {_WORST.format(n=50)} JOIN dim_property USING (property_sk, pin)""")

# Measure by measure, each looked up for a district on its own.
_of = "(SELECT {1} FROM {0} x WHERE x.council_district_sk = d.council_district_sk)".format
model("mart_council_district",
      ["fact_violation", "fact_property_lifecycle", "dim_council_district"], f"""
SELECT council_district, district_label,
  nullif({_of('fact_violation', 'count(*)')}, 0) AS total_violations,
  nullif({_of('fact_violation', 'count(DISTINCT property_sk)')}, 0) AS distinct_properties,
  {_of('fact_property_lifecycle', 'sum(ever_dangerous_building::INT)')}::BIGINT
    AS dangerous_building_count,
  {_of('fact_property_lifecycle', 'avg(ever_dangerous_building::INT)')}
    AS pct_escalated_to_dangerous,
  {_of('fact_violation', 'quantile_disc(days_open, 0.5) FILTER (is_resolved)')}::BIGINT
    AS median_days_to_resolve
FROM dim_council_district d""")

_PLACES = """(SELECT property_sk, pin, street_address, council_district, neighborhood, latitude,
    longitude, latitude::VARCHAR || ',' || longitude::VARCHAR AS lat_lng FROM dim_property)"""
model("mart_dashboard", ["fact_violation", "dim_violation_type", "dim_council_district",
                         "dim_property", "fact_property_lifecycle"], f"""
SELECT violation_pk, violation_id, source_system, date_found,
  date_part('year', date_found)::BIGINT AS year, date_resolved, days_open, is_resolved,
  violation_code, short_label, chapter, violation_description, c.council_district,
  district_label, p.pin, street_address, neighborhood, latitude, longitude, lat_lng,
  current_stage, ever_dangerous_building, total_violations
FROM {_PLACES} p
  FULL JOIN (SELECT property_sk, current_stage, ever_dangerous_building, total_violations
             FROM fact_property_lifecycle) USING (property_sk)
  RIGHT JOIN fact_violation USING (property_sk)
  LEFT JOIN dim_council_district c USING (council_district_sk)
  LEFT JOIN dim_violation_type USING (violation_type_sk)""")

model("mart_property_points", ["fact_property_lifecycle", "dim_property"], f"""
SELECT p.* EXCLUDE (property_sk), total_violations, current_stage, ever_dangerous_building
FROM {_PLACES} p JOIN fact_property_lifecycle f USING (property_sk)
WHERE lat_lng IS NOT NULL""")

model("mart_resolution_time", ["fact_violation", "dim_council_district"], """
SELECT date_part('year', date_found)::BIGINT AS year, council_district,
  (quantile_disc(days_open, 0.5) FILTER (is_resolved))::BIGINT AS median_days_to_resolve,
  avg(days_open) FILTER (is_resolved) AS avg_days_to_resolve
FROM dim_council_district JOIN fact_violation USING (council_district_sk) GROUP BY ALL""")

model("mart_top_violation_types", ["fact_violation", "dim_violation_type"], """
SELECT violation_code, short_label, chapter, violation_description,
  count(*) AS violation_count, count(*)::DOUBLE / sum(count(*)) OVER () AS pct_of_total,
  avg(days_open) AS avg_days_open
FROM fact_violation LEFT JOIN dim_violation_type USING (violation_type_sk)
GROUP BY violation_code, short_label, chapter, violation_description
QUALIFY row_number() OVER (ORDER BY violation_code = 'UNKNOWN', count(*) DESC,
                           violation_code) <= 20 AND violation_code <> 'UNKNOWN'""")

model("mart_violations_trend", ["fact_violation"], """
SELECT date_part('year', date_found)::BIGINT AS year, source_system,
  count(*) AS total_violations, count_if(is_resolved)::BIGINT AS resolved_violations,
  quantile_disc(days_open, 0.5)::BIGINT AS median_days_open
FROM fact_violation GROUP BY ALL""")


def _order(name: str, seen: list[str]) -> None:
    if name in seen:
        return
    for dep in MODELS[name][0]:
        _order(dep, seen)
    seen.append(name)


def sql_for(names: str | list[str], select: str | None = None, extra: str = "") -> str:
    """One statement: the models and their inputs as CTEs, ``extra`` CTEs, then
    ``select``."""
    names = [names] if isinstance(names, str) else list(names)
    seen: list[str] = []
    for name in names:
        _order(name, seen)
    ctes = ",\n".join(f"{n} AS ({MODELS[n][1]}\n)" for n in seen)
    more = f",\n{extra}" if extra else ""
    return f"WITH {ctes}{more}\n{select or f'SELECT * FROM {names[0]}'}"


# ---- upkeep of the snapshot between two drops --------------------------------------
def snapshot_changes_sql() -> str:
    """Pins by what the second drop of the live feed does to them: the rows of a pin in
    both drops are compared as sorted lists."""
    case = "casenumber::BIGINT"
    drop1 = f"""
earlier_drop AS (
  SELECT * REPLACE (if({case} % 19 = 0, NULL, date_resolved) AS date_resolved)
  FROM npd_violations WHERE {case} % 17 <> 0 OR violationid LIKE '%-1'
  UNION ALL
  SELECT * REPLACE ('x' || violationid AS violationid,
                    if({case} % 2 = 0, 'x' || trim(pin), pin) AS pin)
  FROM npd_violations WHERE {case} % 23 = 0 AND violationid LIKE '%-1'),
earlier_staged AS ({_project(_CURRENT, 'earlier_drop', 'violationid IS NOT NULL')}),
earlier_rows AS (SELECT {_HISTORY} FROM earlier_staged),
later_rows AS (SELECT {_HISTORY} FROM stg_violations_current),
earlier_pins AS (
  SELECT pin, list(row ORDER BY row) AS rows FROM (
    SELECT pin, to_json(r) AS row FROM (SELECT * EXCLUDE (days_open) FROM earlier_rows) r
    WHERE length(pin) > 0) GROUP BY pin),
later_pins AS (
  SELECT pin, list(row ORDER BY row) AS rows FROM (
    SELECT pin, to_json(r) AS row FROM (SELECT * EXCLUDE (days_open) FROM later_rows) r
    WHERE length(pin) > 0) GROUP BY pin)"""
    return sql_for(["npd_violations", "stg_violations_current"], """
SELECT CASE WHEN e.rows IS NULL THEN 'new' WHEN l.rows IS NULL THEN 'gone'
            WHEN e.rows = l.rows THEN 'same' ELSE 'changed' END AS change,
  count(*) AS pins, coalesce(sum(len(l.rows)), 0)::BIGINT AS live_rows
FROM earlier_pins e FULL JOIN later_pins l ON e.pin = l.pin GROUP BY 1""", extra=drop1)


def hot_property_sql() -> str:
    """The wide table where the first two violations of a case have no property."""
    dashboard = MODELS["mart_dashboard"][1].replace(
        "RIGHT JOIN fact_violation", "RIGHT JOIN moved_fact")
    return sql_for(MODELS["mart_dashboard"][0], dashboard, extra=f"""
moved_fact AS (SELECT * REPLACE (
  if(violation_id LIKE '%-1' OR violation_id LIKE '%-2', {sk("'UNKNOWN'")}, property_sk)
  AS property_sk) FROM fact_violation)""")


# ---- the map ------------------------------------------------------------------------
def heatmap_tiles_sql(zooms: list[int]) -> str:
    place = "least(floor(({} - {}) / ({}) * 2.0::DOUBLE ** zoom), 2.0::DOUBLE ** zoom - 1)::BIGINT".format
    return sql_for("mart_property_points", f"""
SELECT zoom, {place('longitude', '-94.9::DOUBLE', '-94.3::DOUBLE - -94.9::DOUBLE')} AS tile_x,
  {place('latitude', '38.8::DOUBLE', '39.5::DOUBLE - 38.8::DOUBLE')} AS tile_y,
  count(*) AS properties, sum(total_violations)::BIGINT AS violations,
  count_if(ever_dangerous_building)::BIGINT AS dangerous
FROM mart_property_points, (SELECT unnest({zooms})::INTEGER AS zoom) GROUP BY ALL""")


def points_in_box_sql(box) -> str:
    return sql_for("mart_property_points", f"""
SELECT * FROM mart_property_points
WHERE latitude BETWEEN {box.south} AND {box.north} AND longitude BETWEEN {box.west} AND {box.east}""")


# ---- dashboard metrics on the wide table (L1-L10) -------------------------------
def _scope(scope) -> str:
    district, first, last = scope if isinstance(scope, tuple) else (scope, None, None)
    tests = [f"council_district = '{district}'"] if district is not None else []
    tests += [f"date_found >= DATE '{first}'"] if first else []
    tests += [f"date_found <= DATE '{last}'"] if last else []
    return f"WHERE {' AND '.join(tests)}" if tests else ""


def live_sql(kind: str, scope=None) -> str:
    w = f"(SELECT * FROM mart_dashboard {_scope(scope)})"
    cd = "COUNT(DISTINCT {})".format
    if kind == "funnel":
        flags = ("TRUE", "total_violations >= 2", "ever_dangerous_building",
                 "current_stage = 'demolition'")
        lists = ", ".join(f"len(list_distinct(list(pin) FILTER (pin IS NOT NULL AND {f})))"
                          for f in flags)
        sel = f"""
SELECT i AS stage_order,
  ['Any violation', 'Repeat violations', 'Dangerous building', 'Demolition'][i] AS stage,
  ifnull(n[i], 0)::BIGINT AS property_count
FROM (SELECT unnest(range(1, 5)) AS i, n FROM (SELECT [{lists}] AS n FROM {w}))"""
    elif kind == "kpis":
        sel = f"""
SELECT {cd('pin')} AS properties,
  {div(cd('CASE WHEN ever_dangerous_building THEN pin END'), cd('pin'))} AS pct_escalated,
  CAST(COUNT(*) AS BIGINT) AS total_violations FROM {w}"""
    elif kind == "trend":
        sel = f"SELECT year, CAST(COUNT(*) AS BIGINT) AS violations FROM {w} GROUP BY year"
    elif kind == "top_types":
        sel = f"""SELECT short_label, CAST(COUNT(*) AS BIGINT) AS violations FROM {w}
GROUP BY short_label ORDER BY violations DESC, short_label ASC NULLS FIRST LIMIT 20"""
    elif kind == "resolution":
        sel = f"SELECT year, median(days_open) AS median_days_open FROM {w} GROUP BY year"
    elif kind == "heatmap":
        sel = f"""SELECT lat_lng, CAST(COUNT(*) AS BIGINT) AS violations, {cd('pin')} AS properties
FROM {w} GROUP BY lat_lng"""
    elif kind == "stages":
        sel = f"""SELECT current_stage, {cd('pin')} AS properties FROM {w}
WHERE pin IS NOT NULL GROUP BY current_stage"""
    else:
        raise ValueError(kind)
    return sql_for("mart_dashboard", sel)


def scorecards_sql() -> str:
    return sql_for(["mart_blight_funnel", "mart_council_district"], """
SELECT (SELECT property_count FROM mart_blight_funnel WHERE stage_order = 1) AS properties_cited,
  (SELECT pct_of_violation_properties FROM mart_blight_funnel
   WHERE stage = 'Repeat violations') AS repeat_rate,
  (SELECT pct_of_violation_properties FROM mart_blight_funnel
   WHERE stage = 'Dangerous building') AS pct_escalated,
  (SELECT CAST(SUM(total_violations) AS BIGINT) FROM mart_council_district) AS total_violations""")


def presented_sql() -> str:
    return sql_for("mart_council_district", """
SELECT *, row_number() OVER (ORDER BY total_violations DESC NULLS LAST, council_district) AS place
FROM mart_council_district""")


# ---- data-quality checks (Q1-Q7) ------------------------------------------------
def _test_sql(t) -> str:
    if t.kind == "not_null":
        q = f"SELECT COUNT(*) FROM {t.model} WHERE {t.column} IS NULL"
    elif t.kind == "accepted_values":
        vals = ", ".join(f"'{v}'" for v in t.values)
        q = (f"SELECT COUNT(*) FROM (SELECT {t.column} FROM {t.model} GROUP BY {t.column}) "
             f"WHERE {t.column} NOT IN ({vals})")
    elif t.kind == "unique":
        q = (f"SELECT COUNT(*) FROM (SELECT {t.column} FROM {t.model} WHERE {t.column} IS NOT NULL "
             f"GROUP BY {t.column} HAVING COUNT(*) > 1)")
    else:
        pm, pc = t.parent
        q = (f"SELECT COUNT(*) FROM {t.model} c WHERE c.{t.column} IS NOT NULL AND NOT EXISTS "
             f"(SELECT 1 FROM {pm} p WHERE p.{pc} = c.{t.column})")
    return (f"SELECT '{t.model}' AS model, '{t.column}' AS column_name, '{t.kind}' AS test, "
            f"'{t.severity}' AS severity, CAST(({q}) AS BIGINT) AS failures")


def test_summary_sql(tests) -> str:
    names = sorted({t.model for t in tests} | {t.parent[0] for t in tests if t.parent})
    return sql_for(names, "\nUNION ALL\n".join(_test_sql(t) for t in tests))


def singular_sql(model_name: str, where: str) -> str:
    return sql_for(model_name, f"SELECT * FROM {model_name} WHERE {where}")


def faults_sql() -> str:
    """The checks over the models with planted faults (``plans.faults``)."""
    month = "date_part('month', date_found)"
    faulty = f"""
faulty_once AS (SELECT * REPLACE (
    if({month} = {faults.NULL_KEY}, NULL, property_sk) AS property_sk,
    if({month} = {faults.ORPHAN}, 'orphan', council_district_sk) AS council_district_sk,
    if({month} = {faults.NEGATIVE}, -1, days_open) AS days_open) FROM fact_violation),
faulty_fact_violation AS (FROM faulty_once UNION ALL
    FROM faulty_once WHERE date_part('day', date_found) = 1),
faulty_fact_property_lifecycle AS (SELECT * REPLACE (
    if(total_violations = 1, '{faults.UNKNOWN_STAGE}', current_stage) AS current_stage)
    FROM fact_property_lifecycle),
faulty_int_violations_unioned AS (SELECT * REPLACE (
    if({month} = {faults.EARLY}, date_found - 1, date_resolved) AS date_resolved)
    FROM int_violations_unioned)"""
    where = {"assert_no_negative_days_open": "days_open < 0",
             "assert_resolved_after_found": "date_resolved < date_found"}
    rows = [_test_sql(t) for t in faults.TESTS] + [
        f"SELECT '{model}', '', '{key}', 'error', (SELECT count(*) FROM {model} WHERE {where[key]})"
        for key, model in faults.SINGULAR.items()]
    names = sorted({"fact_violation", "fact_property_lifecycle", "int_violations_unioned"}
                   | {t.parent[0] for t in faults.TESTS if t.parent})
    return sql_for(names, "\nUNION ALL\n".join(rows), extra=faulty)


# ---- the operators on the events table -------------------------------------------
EVENTS_SQL = {
    "latest_event_per_user": """
SELECT user_id, ts, event_id, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
    event_id DESC NULLS LAST, event_type DESC NULLS LAST, value DESC NULLS LAST) AS rn
  FROM events) WHERE rn = 1""",
    "event_prop_scalar": f"""
SELECT event_id, {to_double("json_extract_string(props, '$.k')")} AS prop_k FROM events""",
    "events_by_month": """
SELECT CAST(year(ts) AS BIGINT) AS year, CAST(month(ts) AS BIGINT) AS month, event_type,
  CAST(COUNT(*) AS BIGINT) AS events, COUNT(CASE WHEN value > 10 THEN 1 END) AS events_over_10,
  quantile_disc(value, 0.5) AS median_value
FROM events GROUP BY 1, 2, 3""",
}


def listed_without_violations_sql() -> str:
    return sql_for(["stg_dangerous_buildings", "int_property_rollup"], """
SELECT d.pin, d.case_number, d.case_opened, d.status_of_case, d.is_demolition_status
FROM stg_dangerous_buildings d LEFT JOIN int_property_rollup p USING (pin)
WHERE p.pin IS NULL""")


# ---- the cleaning helpers alone -------------------------------------------------
CLEANING_SQL = {
    "ordinance_codes": sql_for(["npd_violations", "historical_violations"], f"""
SELECT ordinance, {norm_code('ordinance')} AS violation_code, CAST(COUNT(*) AS BIGINT) AS rows
FROM (SELECT ordinance FROM npd_violations UNION ALL SELECT ordinance FROM historical_violations)
GROUP BY ordinance"""),
    "point_coordinates": sql_for(["npd_violations", "dangerous_buildings"], f"""
SELECT point, {point_coord('point', 1)} AS latitude, {point_coord('point', 0)} AS longitude,
  CAST(COUNT(*) AS BIGINT) AS rows
FROM (SELECT incident_location AS point FROM npd_violations
      UNION ALL SELECT case_location FROM dangerous_buildings)
GROUP BY point"""),
    "numeric_texts": f"""
SELECT text, {to_double('text')} AS parsed, CAST(count(*) AS BIGINT) AS rows
FROM (SELECT CASE p_partkey % 8 WHEN 0 THEN p_size::VARCHAR WHEN 1 THEN '0x' || p_size || 'p3'
        WHEN 2 THEN p_size || '_0' WHEN 3 THEN p_size || 'e2' WHEN 4 THEN ' -' || p_size || '.5' || chr(10)
        WHEN 5 THEN p_size || 'd' WHEN 6 THEN p_size || 'e999' ELSE p_brand END AS text FROM part)
GROUP BY text""",
    "date_texts": sql_for(["npd_violations", "historical_violations"], f"""
SELECT text, {to_date('text')} AS parsed, CAST(COUNT(*) AS BIGINT) AS rows
FROM (SELECT date_found AS text FROM npd_violations
      UNION ALL SELECT date_resolved FROM npd_violations
      UNION ALL SELECT violation_entry_date FROM historical_violations
      UNION ALL SELECT case_closed FROM historical_violations)
GROUP BY text"""),
}


def calendar_violations_sql() -> str:
    return sql_for(["dim_date", "fact_violation"], """
SELECT d.date_sk, d.date_day, d.year, d.quarter, d.month, d.month_name,
  CAST(COALESCE(c.violations, 0) AS BIGINT) AS violations
FROM dim_date d
LEFT JOIN (SELECT date_sk, COUNT(*) AS violations FROM fact_violation GROUP BY date_sk) c
  ON d.date_sk = c.date_sk""")
