"""SQL fragments for the expected results.

The expectations are computed straight from the given tables and never see a
fixed-width line, so a parser cannot agree with itself.
"""

# One row per station, day and element, as the daily lines hold it.
DAILY_CELLS = """
daily_cells AS (
  SELECT id, date, element, packed // 8 - 1000 AS tenths, packed % 8 AS line
  FROM (
    SELECT 'USC' || lpad(hex(l_suppkey), 8, '0') AS id,
           CAST(l_shipdate AS DATE) AS date,
           CASE WHEN l_returnflag = 'A' THEN 'TMAX' WHEN l_returnflag = 'N' THEN 'TMIN'
                WHEN l_linestatus = 'O' THEN 'PRCP' ELSE 'SNOW' END AS element,
           MAX((CAST(l_quantity * 10 AS BIGINT) - 200 + 1000) * 8 + l_linenumber) AS packed
    FROM lineitem
    GROUP BY ALL
  )
),
daily AS (
  SELECT id, date, element, CAST(tenths / 10.0 AS FLOAT) AS value
  FROM daily_cells WHERE element <> 'SNOW'
)"""

# One row per station, dataset, element and month, as the monthly lines hold it.
def monthly_cells(step: int = 100) -> str:
    return f"""
monthly_cells AS (
  SELECT id, suffix, dataset, element, year, month,
         packed // 8 - 20000 AS hundredths, packed % 8 AS flag
  FROM (
    SELECT 'USH' || lpad(hex(o_custkey // 16), 8, '0') AS id,
           CASE o_orderstatus WHEN 'F' THEN 'FLs.52j' WHEN 'O' THEN 'raw' ELSE 'tob' END
             || '.' || CASE o_orderkey % 3 WHEN 0 THEN 'tmax' WHEN 1 THEN 'tmin' ELSE 'tavg' END
             AS suffix,
           CASE o_orderstatus WHEN 'F' THEN 'FLS52' WHEN 'O' THEN 'RAW' ELSE 'TOB' END AS dataset,
           CASE o_orderkey % 3 WHEN 0 THEN 'Max' WHEN 1 THEN 'Min' ELSE 'Avg' END AS element,
           year(o_orderdate) AS year, month(o_orderdate) AS month,
           MAX((CAST(floor(o_totalprice / {step}) AS BIGINT) * {step // 100} - 1500 + 20000) * 8
               + CAST(substr(o_orderpriority, 1, 1) AS BIGINT)) AS packed
    FROM orders
    GROUP BY ALL
  )
),
monthly_readings AS (
  SELECT DISTINCT id, suffix, dataset, element, year FROM monthly_cells
),
months AS (SELECT unnest(generate_series(1, 12)) AS month),
monthly AS (
  SELECT r.*, m.month, make_date(CAST(r.year AS INT), CAST(m.month AS INT), 1) AS date,
         CAST(c.hundredths / 100.0 AS FLOAT) AS value, c.flag
  FROM monthly_readings r CROSS JOIN months m
  LEFT JOIN monthly_cells c USING (id, suffix, dataset, element, year, month)
)"""


MONTHLY_CELLS = monthly_cells()

# The station list of the daily network, and its lookup.
DAILY_STATIONS = """
copies AS (SELECT unnest([0, 1, 2]) AS copy),
daily_list AS (
  SELECT s_suppkey * 3 + copy AS position,
         'USC' || lpad(hex(s_suppkey), 8, '0') AS id,
         CASE WHEN s_suppkey % 7 = 0 AND copy = 0 THEN NULL
              ELSE CAST((250000 + (s_suppkey * 7919 + copy * 11) % 240000) / 10000.0 AS FLOAT)
         END AS lat,
         CASE WHEN copy = 2 THEN NULL
              ELSE CAST((-1200000 + (s_suppkey * 104729 + copy * 13) % 400000) / 10000.0 AS FLOAT)
         END AS lon,
         CASE WHEN s_suppkey % 4 = 0 THEN NULL
              ELSE CAST((s_suppkey * 31 % 50000) / 10.0 AS FLOAT) END AS elevation,
         CASE WHEN s_nationkey % 6 = 0 THEN NULL ELSE 'S' || chr(s_nationkey + 65) END AS state,
         upper(s_name) AS name
  FROM supplier CROSS JOIN copies
  WHERE copy = 0 OR (copy = 1 AND s_nationkey % 5 = 0) OR (copy = 2 AND s_nationkey % 3 = 0)
),
daily_lookup AS (
  SELECT id, lat, lon FROM daily_list
  WHERE lat IS NOT NULL AND lon IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY position DESC) = 1
)"""

# The same for the monthly network.
MONTHLY_STATIONS = """
monthly_list AS (
  SELECT c_custkey AS position,
         'USH' || lpad(hex(c_custkey // 16), 8, '0') AS id,
         CAST((250000 + (c_custkey * 7919) % 240000) / 10000.0 AS FLOAT) AS lat,
         CASE WHEN c_custkey % 5 = 0 THEN NULL
              ELSE CAST((-1200000 + (c_custkey * 104729) % 400000) / 10000.0 AS FLOAT) END AS lon,
         CAST((c_custkey * 31 % 9999) / 10.0 AS FLOAT) AS elevation,
         'C' || chr(c_nationkey + 65) AS state,
         upper(c_name) AS name
  FROM customer
),
monthly_lookup AS (
  SELECT id, lat, lon FROM monthly_list
  WHERE lat IS NOT NULL AND lon IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY position DESC) = 1
)"""

MEASURE_NAMES = [
    f"{element}_{dataset}" for element in ("max", "min", "avg") for dataset in ("raw", "tob", "fls52")
]


def number(expression: str, digits: int = 4) -> str:
    return f"round(CAST({expression} AS DOUBLE), {digits})"


def text(expression: str) -> str:
    return f"CAST({expression} AS VARCHAR)"


def whole(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def measure(name: str) -> str:
    """The value of a monthly row in one measure, null in the others."""
    element, dataset = name.split("_")
    return (
        f"CASE WHEN element = '{element.capitalize()}' AND dataset = '{dataset.upper()}' "
        "THEN value END"
    )


SPARSE_COLUMNS = ", ".join(f"{number(measure(name))} AS {name}" for name in MEASURE_NAMES)
WIDE_COLUMNS = ", ".join(f"{number(f'MAX({measure(name)})')} AS {name}" for name in MEASURE_NAMES)

# The text of a slot as it stands in the line.
DAILY_SLOT = (
    "lpad(CAST(tenths AS VARCHAR), 5, ' ') || CASE WHEN line = 1 THEN 'T' ELSE ' ' END "
    "|| CASE WHEN line >= 6 THEN 'X' ELSE ' ' END || substr('ZRD06CX', CAST(line AS INT), 1)"
)
MONTHLY_SLOT = (
    "COALESCE(lpad(CAST(hundredths AS VARCHAR), 6, ' ') || substr('abcde', CAST(c.flag AS INT), 1) "
    "|| CASE WHEN c.flag = 5 THEN 'D' ELSE ' ' END || CAST(c.flag AS VARCHAR), ' -9999   ')"
)
MONTHLY_TEXT = f"""
monthly_text AS (
  SELECT r.id || '.' || r.suffix AS file_name, r.id, r.year, m.month, {MONTHLY_SLOT} AS chunk
  FROM monthly_readings r CROSS JOIN months m
  LEFT JOIN monthly_cells c USING (id, suffix, dataset, element, year, month)
),
monthly_line AS (
  SELECT file_name, year, id || ' ' || year || string_agg(chunk, '' ORDER BY month) AS line
  FROM monthly_text GROUP BY file_name, id, year
)"""
