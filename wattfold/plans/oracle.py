"""DuckDB SQL that each registered query must agree with.

Written against the benchmark tables from the meaning of each job, not from its Spark plan:
joins come before sums, segments are billed one by one and gaps come from a full grid.
"""

from __future__ import annotations

READINGS = """
event_readings AS (
    SELECT user_id AS meter_id, CAST(value AS DECIMAL(18,2)) AS measure, ts AS datetime_measured FROM events
),
readings AS (
    SELECT * FROM event_readings
    UNION ALL
    SELECT l_partkey, CAST(l_quantity * l_linenumber AS DECIMAL(18,2)),
           l_shipdate + INTERVAL 1 HOUR * (l_linenumber * 4 - 1)
    FROM lineitem
)"""

FEATURES = f"""{READINGS},
features AS (
    SELECT *, CAST(strftime(datetime_measured, '%Y%m%d') AS INTEGER) AS date_id,
           CASE WHEN hour(datetime_measured) IN (10, 11, 18, 19, 20) THEN 'high'
                WHEN hour(datetime_measured) IN (23, 0, 1, 2, 3, 4) THEN 'low'
                ELSE 'normal' END AS time_of_day
    FROM readings
)"""

PARTIES = """
x_customer AS (
    SELECT c_custkey AS customer_id, c_name AS customer_name,
           c_nationkey || '-' || c_custkey AS phone,
           lower(c_name) || '@example.com' AS email,
           'Main street ' || c_nationkey AS address,
           CASE WHEN c_mktsegment IN ('HOUSEHOLD', 'FURNITURE') THEN 'residential'
                WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE') THEN 'commercial'
                ELSE 'industrial' END AS customer_type
    FROM customer
),
x_contract AS (SELECT c_custkey + 1000000 AS contract_id, c_custkey AS customer_id FROM customer),
x_place AS (
    SELECT n_name AS location, 'XX-' || n_nationkey AS iso_code,
           CAST(n_nationkey * 1.5 AS DOUBLE) AS latitude, CAST(n_nationkey * -2.5 AS DOUBLE) AS longitude
    FROM nation WHERE n_regionkey < 4
),
x_meter AS (
    SELECT m.c_custkey AS meter_id, o.contract_id, o.customer_id, p.customer_type, n.n_name AS location,
           CASE p.customer_type
               WHEN 'commercial' THEN CASE m.c_custkey % 3
                   WHEN 0 THEN 'less than 6kV' WHEN 1 THEN '6kV to less than 22kV' ELSE '22kV and above' END
               WHEN 'industrial' THEN CASE m.c_custkey % 4
                   WHEN 0 THEN 'less than 6kV' WHEN 1 THEN '6kV to less than 22kV'
                   WHEN 2 THEN '22kV to less than 100kV' ELSE '100kV and above' END
           END AS voltage
    FROM customer m
    JOIN x_contract o ON o.customer_id = m.c_custkey // 3
    JOIN x_customer p ON p.customer_id = o.customer_id
    JOIN nation n ON n.n_nationkey = m.c_nationkey
),
x_dim_meter AS (
    SELECT m.meter_id, CASE WHEN m.customer_type = 'residential' THEN 'single-phase' ELSE 'three-phase' END AS meter_type,
           m.voltage, 'active' AS status, m.location, l.latitude, l.longitude, l.iso_code
    FROM x_meter m LEFT JOIN x_place l ON l.location = m.location
)"""

FACT = f"""{FEATURES}, {PARTIES},
dim_date AS (
    SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(day(d) AS INTEGER) AS day,
           CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year
    FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS d)
),
fact AS (
    SELECT f.date_id, m.customer_id, m.contract_id, f.meter_id, f.time_of_day, sum(f.measure) AS consumption
    FROM features f JOIN x_meter m ON m.meter_id = f.meter_id
    GROUP BY ALL
)"""


def _prices(rows: str) -> str:
    return f"SELECT * FROM (VALUES {rows}) AS p(voltage, time_of_day, price)"


PRICES = f"""
commercial_price AS ({_prices('''
    ('less than 6kV', 'normal', 2870), ('less than 6kV', 'low', 1746), ('less than 6kV', 'high', 4937),
    ('6kV to less than 22kV', 'normal', 2830), ('6kV to less than 22kV', 'low', 1666), ('6kV to less than 22kV', 'high', 4736),
    ('22kV and above', 'normal', 2629), ('22kV and above', 'low', 1465), ('22kV and above', 'high', 4575)''')}),
industrial_price AS ({_prices('''
    ('less than 6kV', 'normal', 1809), ('less than 6kV', 'low', 1184), ('less than 6kV', 'high', 3314),
    ('6kV to less than 22kV', 'normal', 1729), ('6kV to less than 22kV', 'low', 1124), ('6kV to less than 22kV', 'high', 3194),
    ('22kV to less than 100kV', 'normal', 1669), ('22kV to less than 100kV', 'low', 1084), ('22kV to less than 100kV', 'high', 3093),
    ('100kV and above', 'normal', 1649), ('100kV and above', 'low', 1044), ('100kV and above', 'high', 2973)''')})"""

BILLS = f"""{FACT}, {PRICES},
billing AS (
    SELECT f.customer_id, f.contract_id, f.meter_id, d.year * 10000 + d.month * 100 + 1 AS date_id,
           f.time_of_day, c.customer_type, f.consumption
    FROM fact f JOIN dim_date d ON d.date_id = f.date_id JOIN x_customer c ON c.customer_id = f.customer_id
),
monthly_residential AS (
    SELECT customer_id, contract_id, meter_id, date_id, CAST(sum(consumption) AS DECIMAL(18,2)) AS consumption
    FROM billing WHERE customer_type = 'residential' GROUP BY ALL
),
monthly_commercial AS (
    SELECT b.customer_id, b.contract_id, b.meter_id, b.date_id, b.time_of_day, m.voltage,
           CAST(sum(b.consumption) AS DECIMAL(18,2)) AS consumption
    FROM billing b JOIN x_meter m ON m.meter_id = b.meter_id WHERE b.customer_type = 'commercial' GROUP BY ALL
),
monthly_industrial AS (
    SELECT b.customer_id, b.contract_id, b.meter_id, b.date_id, b.time_of_day, m.voltage,
           CAST(sum(b.consumption) AS DECIMAL(18,2)) AS consumption
    FROM billing b JOIN x_meter m ON m.meter_id = b.meter_id WHERE b.customer_type = 'industrial' GROUP BY ALL
),
bill_residential AS (
    SELECT date_id, customer_id, contract_id, meter_id,
           CASE WHEN consumption <= 50 THEN consumption * 1806
                WHEN consumption <= 100 THEN 90300 + (consumption - 50) * 1866
                WHEN consumption <= 200 THEN 183600 + (consumption - 100) * 2167
                WHEN consumption <= 300 THEN 400300 + (consumption - 200) * 2729
                WHEN consumption <= 400 THEN 673200 + (consumption - 300) * 3050
                ELSE 978200 + (consumption - 400) * 3151 END AS revenue
    FROM monthly_residential
),
bill_commercial AS (
    SELECT date_id, customer_id, contract_id, meter_id, sum(consumption * price) AS revenue
    FROM monthly_commercial JOIN commercial_price USING (voltage, time_of_day) GROUP BY ALL
),
bill_industrial AS (
    SELECT date_id, customer_id, contract_id, meter_id, sum(consumption * price) AS revenue
    FROM monthly_industrial JOIN industrial_price USING (voltage, time_of_day) GROUP BY ALL
),
bill AS (
    SELECT * FROM bill_residential UNION ALL SELECT * FROM bill_commercial UNION ALL SELECT * FROM bill_industrial
)"""

LOADS = f"""{READINGS}, {PARTIES},
customer_source AS (
    SELECT c.*, o.updated_date
    FROM x_customer c LEFT JOIN (
        SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS updated_date FROM orders WHERE o_orderstatus = 'P' GROUP BY 1
    ) o ON o.o_custkey = c.customer_id
),
customer_target AS (
    SELECT c.customer_id, upper(c.customer_name) AS customer_name, c.phone, c.email, 'unknown' AS address,
           c.customer_type, o.updated_date
    FROM x_customer c JOIN (
        SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS updated_date FROM orders
        WHERE o_orderpriority = '1-URGENT' AND o_orderdate < TIMESTAMP '2001-01-01' GROUP BY 1
    ) o ON o.o_custkey = c.customer_id
),
customer_fresh AS (
    SELECT * FROM customer_source WHERE updated_date > (SELECT max(updated_date) FROM customer_target)
),
contract_source AS (
    SELECT o_orderkey AS contract_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS date_created,
           o_orderstatus AS status, l.updated_date
    FROM orders LEFT JOIN (
        SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS updated_date FROM lineitem GROUP BY 1
    ) l ON l.l_orderkey = o_orderkey
),
contract_target AS (
    SELECT o_orderkey AS contract_id, CAST(o_orderdate AS DATE) AS date_created, 'X' AS status,
           CAST(o_orderdate AS DATE) AS updated_date
    FROM orders WHERE CAST(o_orderdate AS DATE) < DATE '1998-01-01'
),
contract_fresh AS (
    SELECT contract_id, date_created, status, updated_date FROM contract_source
    WHERE updated_date > (SELECT max(updated_date) FROM contract_target)
),
meter_source AS (
    SELECT m.*, r.updated_date
    FROM x_dim_meter m LEFT JOIN (
        SELECT meter_id, max(CAST(datetime_measured AS DATE)) AS updated_date FROM readings GROUP BY 1
    ) r ON r.meter_id = m.meter_id
),
meter_target AS (
    SELECT m.meter_id, m.meter_type, m.voltage, 'installed' AS status, 'unknown' AS location,
           m.latitude, m.longitude, m.iso_code, l.updated_date
    FROM x_dim_meter m JOIN (
        SELECT l_partkey, max(CAST(l_shipdate AS DATE)) AS updated_date FROM lineitem
        WHERE l_discount = 0 AND l_shipdate < TIMESTAMP '2001-07-01' GROUP BY 1
    ) l ON l.l_partkey = m.meter_id
),
meter_fresh AS (
    SELECT * FROM meter_source WHERE updated_date > (SELECT max(updated_date) FROM meter_target)
)"""

SEGMENTED = f"""{READINGS}, {PARTIES},
segmented AS (
    SELECT r.meter_id, r.measure, r.datetime_measured, m.customer_type,
           hour(r.datetime_measured) AS h, isodow(r.datetime_measured) <= 5 AS workday,
           quarter(r.datetime_measured) IN (2, 4) AS summer
    FROM readings r JOIN x_meter m ON m.meter_id = r.meter_id
),
loaded AS (
    SELECT meter_id, measure, datetime_measured, customer_type,
           CASE WHEN customer_type = 'residential' AND workday AND summer THEN CASE WHEN h >= 17 THEN 1.3 ELSE 0.9 END
                WHEN customer_type = 'residential' AND workday THEN CASE WHEN h >= 17 THEN 1.0 ELSE 0.6 END
                WHEN customer_type = 'residential' THEN CASE WHEN h >= 8 THEN 1.0 ELSE 0.6 END
                WHEN workday AND h BETWEEN 8 AND 17 THEN 1.0 ELSE 0.6 END AS load_factor
    FROM segmented
),
ranged AS (
    SELECT *, CASE customer_type WHEN 'residential' THEN 2 WHEN 'commercial' THEN 10 ELSE 50 END * load_factor AS low,
              CASE customer_type WHEN 'residential' THEN 5 WHEN 'commercial' THEN 100 ELSE 500 END * load_factor AS high
    FROM loaded
)"""


def _with(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select}"


def _upsert(name: str, key: str) -> str:
    return _with(
        LOADS,
        f"SELECT * FROM {name}_target WHERE {key} NOT IN (SELECT {key} FROM {name}_fresh) "
        f"UNION ALL SELECT * FROM {name}_fresh",
    )


# The fact of the events alone.
EVENT_FACT = FACT.replace(READINGS, READINGS.split("readings AS (\n    SELECT * FROM")[0] + "readings AS (SELECT * FROM event_readings)")


def _daily(columns: str, joins: str = "", fact: str = FACT) -> str:
    return _with(
        fact,
        f"SELECT {columns + ', ' if columns else ''}d.day, d.month, d.year, "
        f"CAST(CAST(sum(f.consumption) AS DECIMAL(18,2)) AS DOUBLE) AS consumption "
        f"FROM fact f JOIN dim_date d ON d.date_id = f.date_id {joins} GROUP BY ALL",
    )


def _monthly_revenue(columns: str, joins: str = "") -> str:
    return _with(
        BILLS,
        f"SELECT {columns + ', ' if columns else ''}d.month, d.year, "
        f"CAST(CAST(sum(f.revenue) AS DECIMAL(18,2)) AS DOUBLE) AS revenue "
        f"FROM bill f JOIN dim_date d ON d.date_id = f.date_id {joins} GROUP BY ALL",
    )


def _bill(table: str) -> str:
    return _with(
        BILLS,
        f"SELECT date_id, customer_id, contract_id, meter_id, "
        f"CAST(CAST(revenue AS DECIMAL(18,2)) AS DOUBLE) AS revenue FROM {table}",
    )


def _monthly(table: str) -> str:
    return _with(BILLS, f"SELECT * REPLACE (CAST(consumption AS DOUBLE) AS consumption) FROM {table}")


CUSTOMER = "JOIN x_customer c ON c.customer_id = f.customer_id"
METER = "JOIN x_dim_meter m ON m.meter_id = f.meter_id"
LINE = "user_id || ',' || value || ',' || strftime(ts, '%Y-%m-%d %H:%M:%S')"
LANDED = "SELECT user_id AS meter_id, value AS measure, date_trunc('second', ts) AS datetime_measured"

ORACLES: dict[str, str] = {
    "fact_power_consumption": _with(FACT, "SELECT * REPLACE (CAST(CAST(consumption AS DECIMAL(18,2)) AS DOUBLE) AS consumption) FROM fact"),
    "reading_features": _with(FEATURES, "SELECT * REPLACE (CAST(measure AS DOUBLE) AS measure) FROM features"),
    "customer_meter_bridge": _with(PARTIES, "SELECT customer_id, contract_id, meter_id FROM x_meter"),
    "dim_date": _with(
        READINGS,
        """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, CAST(d AS DATE) AS date,
                  CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month,
                  CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter
           FROM (SELECT unnest(generate_series(min(CAST(datetime_measured AS DATE)),
                                               max(CAST(datetime_measured AS DATE)), INTERVAL 1 DAY)) AS d FROM readings)""",
    ),
    "price_tables": _with(
        f"{PARTIES}, {PRICES}",
        """SELECT m.customer_type, p.voltage AS voltage_tier, p.time_of_day, CAST(p.price AS DOUBLE) AS price, count(*) AS meters
           FROM x_meter m
           JOIN (SELECT 'commercial' AS customer_type, * FROM commercial_price
                 UNION ALL SELECT 'industrial', * FROM industrial_price
                 UNION ALL SELECT 'residential', * FROM (VALUES
                     ('0-50 kWh', '1', 1806), ('51-100 kWh', '2', 1866), ('101-200 kWh', '3', 2167),
                     ('201-300 kWh', '4', 2729), ('301-400 kWh', '5', 3050), ('More than 401 kWh', '6', 3151))) p
             ON p.customer_type = m.customer_type AND (p.voltage = m.voltage OR m.customer_type = 'residential')
           GROUP BY ALL""",
    ),
    "month_key": "SELECT o_orderkey, CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + 1 AS INTEGER) AS date_id FROM orders",
    "segment_month_filter": _with(
        FACT,
        """SELECT f.date_id, f.customer_id, f.contract_id, f.meter_id, f.time_of_day, d.year, d.month,
                  CAST(CAST(f.consumption AS DECIMAL(18,2)) AS DOUBLE) AS consumption
           FROM fact f JOIN dim_date d ON d.date_id = f.date_id JOIN x_customer c ON c.customer_id = f.customer_id
           WHERE c.customer_type = 'commercial' AND d.year = 2024 AND d.month = 1""",
    ),
    "view_daily_total_consumption": _daily(""),
    "view_daily_consumption_by_customer": _daily("c.customer_id, c.customer_name, c.customer_type", CUSTOMER),
    "view_daily_consumption_by_customer_type": _daily("c.customer_type", CUSTOMER),
    "view_daily_consumption_by_location": _daily("m.location, m.iso_code", METER),
    "view_daily_consumption_by_meter": _daily("c.customer_id, c.customer_name, m.meter_id", f"{CUSTOMER} {METER}"),
    "view_daily_consumption_by_time_of_day": _daily(
        "c.customer_id, c.customer_name, m.meter_id, f.time_of_day", f"{CUSTOMER} {METER}"
    ),
    "monthly_consumption_residential": _monthly("monthly_residential"),
    "monthly_consumption_commercial": _monthly("monthly_commercial"),
    "monthly_consumption_industrial": _monthly("monthly_industrial"),
    "revenue_residential": _bill("bill_residential"),
    "revenue_residential_slab": _with(
        BILLS,
        """SELECT date_id, customer_id, contract_id, meter_id, CAST(
                  least(consumption, 50) * 1806
                  + greatest(least(consumption, 100) - 50, 0) * 1866
                  + greatest(least(consumption, 200) - 100, 0) * 2167
                  + greatest(least(consumption, 300) - 200, 0) * 2729
                  + greatest(least(consumption, 400) - 300, 0) * 3050
                  + greatest(consumption - 400, 0) * 3151 AS DOUBLE) AS revenue
           FROM monthly_residential""",
    ),
    "revenue_commercial": _bill("bill_commercial"),
    "revenue_industrial": _bill("bill_industrial"),
    "fact_revenue": _bill("bill"),
    "view_monthly_total_revenue": _monthly_revenue(""),
    "view_monthly_revenue_by_customer": _monthly_revenue("c.customer_id, c.customer_name, c.customer_type", CUSTOMER),
    "view_monthly_revenue_by_customer_type": _monthly_revenue("c.customer_type", CUSTOMER),
    "preview_revenue_top20": _bill("bill_residential") + " ORDER BY customer_id, contract_id, meter_id, date_id LIMIT 20",
    "incremental_watermark": _with(
        LOADS, "SELECT coalesce(max(updated_date), DATE '1900-01-01') AS watermark FROM contract_target"
    ),
    "incremental_slice": _with(LOADS, "SELECT * FROM contract_fresh"),
    "upsert_changed_keys": _with(
        LOADS, "SELECT * FROM customer_fresh WHERE customer_id IN (SELECT customer_id FROM customer_target)"
    ),
    "upsert_new_keys": _with(
        LOADS, "SELECT * FROM customer_fresh WHERE customer_id NOT IN (SELECT customer_id FROM customer_target)"
    ),
    "upsert_dim_customer": _upsert("customer", "customer_id"),
    "upsert_dim_contract": _upsert("contract", "contract_id"),
    "upsert_dim_meter": _upsert("meter", "meter_id"),
    "default_updated_date": _with(
        LOADS, "SELECT * REPLACE (coalesce(updated_date, DATE '2024-02-01') AS updated_date) FROM customer_source"
    ),
    "meter_expand": """
        SELECT (c.id - 1) * 5 + k.k AS meter_id, c.id AS contract_id,
               CASE WHEN c.id <= 10000 THEN 'single-phase' ELSE 'three-phase' END AS meter_type
        FROM (SELECT o_orderkey + 1 AS id FROM orders) c
        JOIN (SELECT unnest(generate_series(1, 5)) AS k) k
          ON k.k <= CASE WHEN c.id BETWEEN 1 AND 10000 THEN 1 ELSE 1 + c.id % 5 END""",
    "contract_from_customer": """
        SELECT c_custkey AS contract_id, c_custkey AS customer_id, DATE '2023-01-02' AS date_created, 'active' AS status
        FROM customer""",
    "check_pk_duplicates": _with(
        FACT,
        """SELECT date_id, customer_id, contract_id, meter_id, count(*) AS n FROM fact
           GROUP BY ALL HAVING count(*) > 1""",
    ),
    "check_fk_orphans": _with(
        f"{READINGS}, {PARTIES}",
        """SELECT r.meter_id, count(*) AS n FROM readings r
           WHERE NOT EXISTS (SELECT 1 FROM x_meter m WHERE m.meter_id = r.meter_id) GROUP BY ALL""",
    ),
    "check_unique": "SELECT o_custkey AS customer_id, count(*) AS n FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "location_code_enrich": _with(
        PARTIES,
        """SELECT m.location, m.meter_id, l.iso_code, l.latitude, l.longitude
           FROM x_meter m LEFT JOIN x_place l ON l.location = m.location""",
    ),
    "segment_by_contract_range": """
        SELECT o_orderkey AS contract_id, CASE WHEN o_orderkey BETWEEN 1 AND 10000 THEN 'residential'
               WHEN o_orderkey BETWEEN 10001 AND 10100 THEN 'commercial' ELSE 'industrial' END AS customer_type
        FROM orders""",
    "load_factor": _with(
        SEGMENTED,
        """SELECT * REPLACE (CAST(measure AS DOUBLE) AS measure, CAST(load_factor AS DOUBLE) AS load_factor)
           FROM loaded""",
    ),
    "load_band_check": _with(
        SEGMENTED,
        """SELECT meter_id, datetime_measured, customer_type, CAST(measure AS DOUBLE) AS measure,
                  CAST(load_factor AS DOUBLE) AS load_factor, CAST(low AS DOUBLE) AS low, CAST(high AS DOUBLE) AS high
           FROM ranged WHERE measure < low OR measure > high""",
    ),
    "reading_grid_gaps": _with(
        READINGS,
        """, hours AS (SELECT unnest(generate_series(date_trunc('month', first), date_trunc('month', last) + INTERVAL 1 MONTH - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hour_missing
           FROM (SELECT min(ts) AS first, max(ts) AS last FROM events))
           SELECT m.meter_id, h.hour_missing
           FROM (SELECT DISTINCT meter_id FROM event_readings) m CROSS JOIN hours h
           WHERE NOT EXISTS (SELECT 1 FROM event_readings r
                             WHERE r.meter_id = m.meter_id AND date_trunc('hour', r.datetime_measured) = h.hour_missing)""",
    ),
    "encode_reading_payload": f"SELECT event_id, {LINE} AS value FROM events",
    "parse_reading_payload": f"""
        SELECT event_id, CASE WHEN event_type <> 'error' THEN user_id END AS meter_id, value AS measure,
               CASE WHEN event_type <> 'signup' THEN date_trunc('second', ts) END AS datetime_measured,
               event_type NOT IN ('error', 'signup') AS valid,
               CASE event_type WHEN 'error' THEN 'bad' || {LINE} WHEN 'signup' THEN user_id || ',' || value END AS raw
        FROM events""",
    "scan_readings_csv": f"{LANDED} FROM events",
    "hourly_csv_partitions": f"{LANDED}, CAST(strftime(ts, '%Y%m%d%H0000') AS BIGINT) AS hour_stamp FROM events",
    "stream_ingest_readings": f"{LANDED} FROM events",
    "stream_dedup_readings": f"SELECT DISTINCT * FROM ({LANDED} FROM events)",
    "stream_land_csv": f"{LANDED}, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS land_day FROM events",
    "ingest_latency": """
        WITH delays AS (
            SELECT CAST(ts AS DATE) AS day, (epoch_us(ts) - epoch_us(date_trunc('second', ts))) // 1000 AS delay FROM events
        ), placed AS (
            SELECT *, greatest(length(bin(delay)) - 7, 0) AS cut, count(*) OVER (PARTITION BY day) AS n,
                   row_number() OVER (PARTITION BY day ORDER BY delay) AS place
            FROM delays
        )
        SELECT day, count(*) AS readings, max(delay) AS max_ms, CAST(sum(delay) AS DOUBLE) / count(*) AS mean_ms,
               max(CASE WHEN place = (50 * n + 99) // 100 THEN (delay >> cut) << cut END) AS p50_ms,
               max(CASE WHEN place = (95 * n + 99) // 100 THEN (delay >> cut) << cut END) AS p95_ms
        FROM placed
        GROUP BY ALL""",
    "stream_late_repeats": f"SELECT DISTINCT * FROM ({LANDED} FROM events)",
    "publish_fact_slices": _with(EVENT_FACT, "SELECT * REPLACE (CAST(CAST(consumption AS DECIMAL(18,2)) AS DOUBLE) AS consumption) FROM fact"),
    "refresh_daily_consumption_by_customer_type": _daily("c.customer_type", CUSTOMER, EVENT_FACT),
    "refresh_daily_consumption_by_location": _daily("m.location, m.iso_code", METER, EVENT_FACT),
    "speed_table_compacted": "SELECT user_id AS meter_id, value AS measure, ts AS datetime_measured FROM events",
    "upsert_buckets_customer": _upsert("customer", "customer_id"),
    "upsert_buckets_meter": _upsert("meter", "meter_id"),
    "reconcile_customers": _with(
        LOADS,
        "SELECT s.customer_id, CASE WHEN t.customer_id IS NULL THEN 'missing' ELSE 'edited' END AS kind "
        "FROM customer_source s LEFT JOIN ("
        "SELECT * FROM customer_target WHERE customer_id NOT IN (SELECT customer_id FROM customer_fresh) "
        "UNION ALL SELECT * FROM customer_fresh) t ON t.customer_id = s.customer_id "
        "WHERE t.customer_id IS NULL OR s.customer_name <> t.customer_name OR s.address <> t.address "
        "OR s.updated_date IS DISTINCT FROM t.updated_date",
    ),
    "load_silent_edits": _with(LOADS, "SELECT * FROM customer_source"),
}
