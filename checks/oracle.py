"""The SQL that each registered query is checked against."""

SHARED = """
order_weights AS (
  SELECT l_orderkey, sum(l_quantity) AS weight FROM lineitem GROUP BY l_orderkey
),
bronze_shipments AS (
  SELECT CAST(o_custkey AS VARCHAR) AS shipment_id, n_name AS origin,
         c_mktsegment AS destination, CAST(weight AS VARCHAR) AS weight_kg,
         CAST(o_totalprice AS VARCHAR) AS declared_value,
         strftime(o_orderdate, '%Y-%m-%d') AS shipping_date, o_orderkey AS order_key
  FROM orders
  LEFT JOIN order_weights ON l_orderkey = o_orderkey
  JOIN customer ON c_custkey = o_custkey
  JOIN nation ON n_nationkey = c_nationkey
),
bronze_tracking AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id,
         CAST(2 * (event_id % (SELECT count(*) FROM customer)) AS VARCHAR) AS shipment_id,
         CASE event_type WHEN 'signup' THEN 'Picked Up' WHEN 'purchase' THEN 'Delivered'
                         WHEN 'error' THEN 'Cancelled' ELSE 'In Transit' END AS event_type,
         strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp,
         'HUB-' || CAST(user_id % 10 AS VARCHAR) AS location
  FROM events
),
rough_shipments AS (
  SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS shipment_id,
         o_orderpriority AS priority, o_orderstatus AS status,
         CASE WHEN o_orderstatus = 'F' THEN o_orderpriority
              ELSE CAST(o_totalprice AS VARCHAR) END AS weight_kg,
         CAST(o_totalprice AS VARCHAR) AS declared_value,
         CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y/%m/%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d') END AS shipping_date,
         o_orderkey AS order_key
  FROM orders
),
rough_tracking AS (
  SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS event_id,
         CAST(user_id AS VARCHAR) AS shipment_id,
         CASE event_type WHEN 'signup' THEN 'Picked Up' WHEN 'purchase' THEN 'Delivered'
                         WHEN 'error' THEN 'Cancelled' ELSE 'In Transit' END AS event_type,
         CASE WHEN event_type = 'click' THEN props
              ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS event_timestamp,
         'HUB-' || CAST(user_id % 10 AS VARCHAR) AS location
  FROM events
),
typed_shipments AS (
  SELECT shipment_id, origin, destination, TRY_CAST(weight_kg AS DOUBLE) AS weight_kg,
         TRY_CAST(declared_value AS DOUBLE) AS declared_value,
         CAST(try_strptime(shipping_date, '%Y-%m-%d') AS DATE) AS shipping_date, order_key
  FROM bronze_shipments
),
typed_rough_shipments AS (
  SELECT shipment_id, priority, status, TRY_CAST(weight_kg AS DOUBLE) AS weight_kg,
         TRY_CAST(declared_value AS DOUBLE) AS declared_value,
         CAST(try_strptime(shipping_date, '%Y-%m-%d') AS DATE) AS shipping_date, order_key
  FROM rough_shipments
),
typed_rough_tracking AS (
  SELECT event_id, shipment_id, event_type,
         TRY_CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, location
  FROM rough_tracking
),
shipments AS (
  SELECT shipment_id, origin, destination, weight_kg, declared_value, shipping_date
  FROM typed_shipments WHERE shipment_id IS NOT NULL
  QUALIFY row_number() OVER (
    PARTITION BY shipment_id ORDER BY shipping_date DESC NULLS LAST, order_key DESC) = 1
),
tracking AS (
  SELECT event_id, shipment_id, event_type,
         CAST(event_timestamp AS TIMESTAMP) AS event_timestamp, location
  FROM bronze_tracking
),
milestones AS (
  SELECT shipment_id,
         min(event_timestamp) FILTER (event_type = 'Picked Up') AS picked_up_time,
         min(event_timestamp) FILTER (event_type = 'Delivered') AS delivered_time
  FROM tracking WHERE event_type IN ('Picked Up', 'Delivered') GROUP BY shipment_id
),
durations AS (
  SELECT shipment_id, picked_up_time, delivered_time,
         (floor(epoch(delivered_time)) - floor(epoch(picked_up_time))) / 86400 AS days
  FROM milestones
),
performance AS (
  SELECT s.*, d.picked_up_time, d.delivered_time, d.days AS delivery_duration_days,
         d.days > 5 AS is_delayed
  FROM shipments s JOIN durations d USING (shipment_id)
),
routes AS (
  SELECT origin, destination, location, count(shipment_id) AS total_shipments,
         CAST(sum(CAST(declared_value AS DECIMAL(18, 2))) AS DOUBLE) AS total_value_at_risk,
         avg(weight_kg) AS avg_weight_kg
  FROM tracking JOIN shipments USING (shipment_id)
  GROUP BY origin, destination, location
),
latest AS (
  SELECT * FROM tracking
  QUALIFY row_number() OVER (
    PARTITION BY shipment_id ORDER BY event_timestamp DESC, event_id DESC) = 1
),
snapshot AS (
  SELECT s.shipment_id, s.origin, s.destination, l.event_type AS current_status,
         l.location AS current_location, l.event_timestamp AS last_updated_at
  FROM shipments s LEFT JOIN latest l ON l.shipment_id = s.shipment_id
)
"""

ORACLES = {}


def oracle(name, body):
    ORACLES[name] = f"WITH {SHARED.strip()}\n{body.strip()}"


def iso(column):
    return (
        f"strftime({column}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN microsecond({column}) % 1000000 = 0 "
        f"THEN '' ELSE strftime({column}, '.%f') END"
    )


def histogram_of(table):
    """Bins of width 1, 2 or 5 times a power of ten, at most 20 of them."""
    return f"""
      SELECT bin * num / den AS bin_start, (bin + 1) * num / den AS bin_end, n
      FROM (
        SELECT floor(delivery_duration_days * den / num) AS bin, num, den, count(*) AS n
        FROM {table}, (
          SELECT num, den
          FROM (
            SELECT lo, hi, CASE WHEN lo = hi THEN 1.0
                     ELSE m * pow(10.0, greatest(e, 0)) END AS num,
                   CASE WHEN lo = hi THEN 1.0 ELSE pow(10.0, greatest(-e, 0)) END AS den
            FROM (
              SELECT min(delivery_duration_days) AS lo, max(delivery_duration_days) AS hi
              FROM {table}
            ), (VALUES (1), (2), (5)) AS mantissa(m), range(-12, 13) AS exponent(e)
          )
          WHERE lo = hi OR (num / den >= (hi - lo) / 20
                AND floor(hi * den / num) - floor(lo * den / num) < 20)
          ORDER BY num / den LIMIT 1
        )
        WHERE delivery_duration_days IS NOT NULL
        GROUP BY bin, num, den
      )"""


def top(label, value, source, k=10):
    return f"SELECT {label}, {value} FROM ({source}) ORDER BY {value} DESC, {label} LIMIT {k}"


def bundle(shipments="snapshot", performance="performance", routes="routes"):
    return f"""
      SELECT 'shipments' AS table_name, * FROM {shipments}
      UNION ALL BY NAME SELECT 'performance' AS table_name, * FROM {performance}
      UNION ALL BY NAME
      SELECT 'routes' AS table_name, * FROM {routes}"""


KPIS = """
  SELECT count(*) AS total_shipments,
         count(*) FILTER (coalesce(current_status, '') NOT IN ('Delivered', 'Cancelled'))
           AS in_transit,
         (SELECT count(*) FILTER (is_delayed) FROM {performance}) AS delayed_shipments,
         (SELECT CASE WHEN count(*) = 0 THEN 0.0
                 ELSE 100 * (1 - count(*) FILTER (is_delayed) / count(*)) END
          FROM {performance}) AS on_time_pct,
         (SELECT coalesce(round(sum(CAST(total_value_at_risk AS DECIMAL(18, 2))), 2), 0)
          FROM {routes}) AS value_at_risk
  FROM {snapshot}"""

COUNTS = "SELECT {column}, count(*) AS n FROM {table} WHERE {column} IS NOT NULL GROUP BY {column}"

RISK = """
  SELECT location, CAST(sum(CAST(total_value_at_risk AS DECIMAL(18, 2))) AS DOUBLE) AS value_at_risk
  FROM {routes} WHERE location IS NOT NULL GROUP BY location"""

BUSIEST = """
  SELECT origin, destination, origin || ' → ' || destination AS route,
         CAST(sum(total_shipments) AS BIGINT) AS total_shipments
  FROM {routes} WHERE origin IS NOT NULL AND destination IS NOT NULL
  GROUP BY origin, destination"""

OUTCOMES = """
  SELECT CASE WHEN is_delayed THEN 'Delayed' ELSE 'On Time' END AS outcome, count(*) AS n
  FROM {performance} GROUP BY 1"""


def long_report(snapshot="snapshot", performance="performance", routes="routes"):
    tables = {"snapshot": snapshot, "performance": performance, "routes": routes}

    def counted(column, table):
        return COUNTS.format(column=column, table=table)

    row = KPIS.format(**tables)
    kpis = " UNION ALL ".join(
        f"SELECT 'kpis' AS dataset, '{name}' AS label, CAST({name} AS DOUBLE) AS value FROM kpi_row"
        for name in (
            "total_shipments", "in_transit", "delayed_shipments", "on_time_pct", "value_at_risk"
        )
    )
    charts = {
        "status_mix": ("current_status", "n", counted("current_status", snapshot)),
        "delay_split": ("outcome", "n", OUTCOMES.format(**tables)),
        "top_origins": ("origin", "n", top("origin", "n", counted("origin", performance))),
        "top_destinations": (
            "destination", "n", top("destination", "n", counted("destination", performance))
        ),
        "duration_histogram": ("bin_start", "n", histogram_of(performance)),
        "value_at_risk_by_location": (
            "location", "value_at_risk", top("location", "value_at_risk", RISK.format(**tables))
        ),
        "daily_volume": ("shipping_date", "n", counted("shipping_date", performance)),
        "busiest_routes": (
            "route", "total_shipments", top("route", "total_shipments", BUSIEST.format(**tables))
        ),
    }
    parts = [
        f"SELECT '{name}' AS dataset, CAST({label} AS VARCHAR) AS label, "
        f"CAST({value} AS DOUBLE) AS value FROM ({source})"
        for name, (label, value, source) in charts.items()
    ]
    union = " UNION ALL ".join([kpis, *parts])
    return (
        f"SELECT dataset, label, round(value, 2) AS value "
        f"FROM (WITH kpi_row AS ({row}) {union})"
    )


def sliced(table, *conditions):
    return f"(SELECT * FROM {table} WHERE {' AND '.join(conditions)})"


TRACKING_TEXT = (
    "SELECT event_id, shipment_id, event_type, event_timestamp, location FROM {table}"
)
CLEAN_CSV = """
  SELECT coalesce(shipment_id, '') AS shipment_id, priority AS origin, status AS destination,
         weight_kg, declared_value, shipping_date
  FROM rough_shipments"""

# Sources, sinks, exchange
oracle("S01_csv_scan", CLEAN_CSV)
for name in ("S01_mixed_headers", "S01_streamed_mixed_headers"):
    oracle(
        name,
        """
    SELECT coalesce(shipment_id, '') AS shipment_id, priority AS origin, status AS destination,
           weight_kg, declared_value, shipping_date,
           CASE WHEN order_key % 2 = 1 THEN CAST(order_key AS VARCHAR) END AS order_key
    FROM rough_shipments""",
    )
oracle(
    "S02_publish_json_messages",
    """
    SELECT '{"event_id":"' || event_id || '","shipment_id":"' || shipment_id
           || '","event_type":"' || event_type || '","event_timestamp":"' || event_timestamp
           || '","location":"' || location || '"}' AS value
    FROM bronze_tracking""",
)
for name in (
    "S03_consume_topic",
    "S04_append_bronze_json",
    "S04_packed_bronze",
    "S06_bronze_scan",
):
    oracle(name, TRACKING_TEXT.format(table="bronze_tracking"))
oracle(
    "S05_declared_bronze_sink", f"SELECT *, true AS within_bound FROM ({TRACKING_TEXT.format(table='bronze_tracking')})"
)
oracle(
    "S05_counted_flush",
    f"SELECT *, (SELECT count(*) // 1000 FROM bronze_tracking) AS full_files FROM ({TRACKING_TEXT.format(table='bronze_tracking')})",
)
oracle("S07_table_overwrite", "SELECT * FROM tracking")
oracle("S08_table_scan", "SELECT * FROM events")
oracle("S09_keyed_upsert", "SELECT * FROM performance")
oracle("S09_streamed_upsert", "SELECT * FROM latest")
oracle("S09_compacted_upsert", "SELECT * FROM latest")
oracle(
    "S09_partial_upsert",
    """
    SELECT * REPLACE (
      CASE WHEN origin = 'NATION_7' THEN is_delayed ELSE delivery_duration_days > 20 END AS is_delayed)
    FROM performance""",
)
oracle("S10_redistribute", "SELECT * FROM snapshot")
oracle("S11_serving_scan", "SELECT * FROM routes")
oracle("S11_live_snapshot", "SELECT * FROM snapshot")
oracle("S12_all_tables_bundle", bundle())
oracle(
    "S13_json_safe_rows",
    f"""
    SELECT shipment_id, origin, destination, weight_kg, declared_value,
           CAST(shipping_date AS VARCHAR) AS shipping_date,
           {iso('picked_up_time')} AS picked_up_time, {iso('delivered_time')} AS delivered_time,
           delivery_duration_days, is_delayed
    FROM performance""",
)

# Projections and scalar functions
oracle("P01_lenient_double", "SELECT order_key, weight_kg, declared_value FROM typed_rough_shipments")
oracle("P02_lenient_date", "SELECT order_key, shipping_date FROM typed_rough_shipments")
oracle(
    "P03_lenient_timestamp",
    "SELECT event_id, shipment_id, event_timestamp FROM typed_rough_tracking",
)
oracle(
    "P04_renaming_projection",
    """
    SELECT shipment_id, origin, destination, event_type AS current_status,
           location AS current_location, event_timestamp AS last_updated_at
    FROM shipments JOIN tracking USING (shipment_id)""",
)
oracle("P05_renamed_pivot_columns", "SELECT * FROM milestones")
oracle(
    "P06_dropped_helper",
    """
    SELECT * FROM tracking
    QUALIFY row_number() OVER (
      PARTITION BY location ORDER BY event_timestamp DESC, event_id DESC) = 1""",
)
oracle("P07_elapsed_days", "SELECT shipment_id, days FROM durations")
oracle(
    "P08_sla_flag",
    "SELECT shipment_id, days > 5 AS is_delayed, days > 10 AS over_ten_days FROM durations",
)
oracle(
    "P09_stripped_text",
    "SELECT order_key, priority AS origin, status AS destination FROM rough_shipments",
)
oracle("P10_json_round_trip", TRACKING_TEXT.format(table="rough_tracking"))
oracle(
    "P11_route_label",
    "SELECT shipment_id, origin || ' → ' || destination AS route FROM shipments",
)
oracle(
    "P12_outcome_label",
    """
    SELECT shipment_id, CASE WHEN is_delayed THEN 'Delayed' ELSE 'On Time' END AS outcome
    FROM performance""",
)
oracle(
    "P13_lenient_read_back",
    """
    SELECT shipment_id, origin, destination, current_status, current_location,
           CASE WHEN current_status IS DISTINCT FROM 'Cancelled' THEN last_updated_at END
             AS last_updated_at
    FROM snapshot""",
)
oracle(
    "P14_unknown_delay_is_false",
    """
    SELECT shipment_id, delivery_duration_days, coalesce(is_delayed, false) AS is_delayed
    FROM performance""",
)
oracle(
    "P15_kpi_text",
    f"""
    SELECT format('{{:,}}', total_shipments) AS total_shipments,
           format('{{:,}}', in_transit) AS in_transit,
           format('{{:.1f}}%', on_time_pct) AS on_time_pct,
           format('{{:,}}', delayed_shipments) AS delayed_shipments,
           '$' || format('{{:,.0f}}', CAST(value_at_risk AS DOUBLE)) AS value_at_risk
    FROM ({KPIS.format(snapshot='snapshot', performance='performance', routes='routes')})""",
)
oracle(
    "P16_any_value_as_text",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
           CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority,
           CAST(o_orderstatus = 'O' AS VARCHAR) AS is_open,
           CAST(o_totalprice * 1024 AS VARCHAR) AS large,
           CAST(o_totalprice / 1073741824 AS VARCHAR) AS small
    FROM orders""",
)

# Filters and predicates
oracle(
    "F01_key_present",
    """
    SELECT order_key, shipment_id, weight_kg, declared_value, shipping_date
    FROM typed_rough_shipments WHERE shipment_id IS NOT NULL""",
)
oracle(
    "F02_timestamp_parsed",
    "SELECT * FROM typed_rough_tracking WHERE event_timestamp IS NOT NULL",
)
oracle(
    "F03_literal_membership",
    "SELECT * FROM tracking WHERE event_type IN ('Picked Up', 'Delivered')",
)
oracle("F04_rank_is_one", "SELECT * FROM latest")
oracle(
    "F05_slicer_filter",
    """
    SELECT * FROM performance
    WHERE origin = 'NATION_3' AND destination = 'BUILDING' AND NOT coalesce(is_delayed, false)""",
)
oracle(
    "F06_slicer_routing",
    bundle(
        sliced("snapshot", "origin = 'NATION_7'"),
        sliced("performance", "origin = 'NATION_7'", "is_delayed"),
        sliced("routes", "origin = 'NATION_7'"),
    ),
)
oracle(
    "F07_text_search",
    "SELECT * FROM snapshot WHERE "
    + " OR ".join(
        f"coalesce(regexp_matches(CAST({column} AS VARCHAR), '(?i)hub-[3-5]|nation_1.*|^cancel'), false)"
        for column in (
            "shipment_id",
            "origin",
            "destination",
            "current_status",
            "current_location",
            "last_updated_at",
        )
    ),
)
oracle(
    "F07_large_amounts",
    """
    SELECT o_orderkey, amount FROM (SELECT o_orderkey, o_totalprice * 1024 AS amount FROM orders)
    WHERE regexp_matches(CAST(amount AS VARCHAR), '00000|[0-9]{8}[.]5')
       OR regexp_matches(CAST(o_orderkey AS VARCHAR), '00000|[0-9]{8}[.]5')""",
)
oracle(
    "F07_literal_search",
    "SELECT * FROM performance WHERE "
    + " OR ".join(
        f"coalesce(contains(CAST({column} AS VARCHAR), '1.2'), false)"
        for column in (
            "shipment_id",
            "origin",
            "destination",
            "weight_kg",
            "declared_value",
            "shipping_date",
            "picked_up_time",
            "delivered_time",
            "delivery_duration_days",
            "is_delayed",
        )
    ),
)
oracle(
    "F08_open_shipments",
    """
    SELECT * FROM snapshot
    WHERE current_status IS NULL OR current_status NOT IN ('Delivered', 'Cancelled')""",
)
oracle(
    "F09_dated_rows",
    "SELECT order_key, shipping_date FROM typed_rough_shipments WHERE shipping_date IS NOT NULL",
)

# Joins
oracle("J01_shipments_with_milestones", "SELECT * FROM shipments JOIN milestones USING (shipment_id)")
for name in ("J02_events_with_shipments", "J02_events_of_hot_shipments"):
    oracle(name, "SELECT * FROM tracking JOIN shipments USING (shipment_id)")
oracle(
    "J03_shipments_with_latest_event",
    """
    SELECT s.*, l.event_id, l.event_type, l.event_timestamp, l.location
    FROM shipments s LEFT JOIN latest l ON l.shipment_id = s.shipment_id""",
)

# Aggregations
oracle(
    "A01_milestone_pivot",
    """
    SELECT shipment_id,
           min(event_timestamp) FILTER (event_type = 'Picked Up') AS picked_up_time,
           min(event_timestamp) FILTER (event_type = 'Delivered') AS delivered_time
    FROM typed_rough_tracking WHERE event_type IN ('Picked Up', 'Delivered')
    GROUP BY shipment_id""",
)
oracle("A02_route_metrics", "SELECT * FROM routes")
oracle(
    "A03_one_shipment_per_key",
    """
    SELECT shipment_id, '  ' || priority || chr(9) AS origin, status || ' ' AS destination,
           weight_kg, declared_value, shipping_date, order_key
    FROM typed_rough_shipments WHERE shipment_id IS NOT NULL
    QUALIFY row_number() OVER (
      PARTITION BY shipment_id ORDER BY shipping_date DESC NULLS LAST, order_key DESC) = 1""",
)
oracle(
    "A03_one_event_per_key",
    """
    SELECT * FROM typed_rough_tracking WHERE event_timestamp IS NOT NULL
    QUALIFY row_number() OVER (
      PARTITION BY event_id ORDER BY event_timestamp DESC, shipment_id DESC, event_type DESC,
                                     location DESC) = 1""",
)
oracle(
    "A04_status_mix",
    """
    SELECT current_status AS status, count(*) AS n FROM snapshot
    WHERE current_status IS NOT NULL GROUP BY current_status""",
)
oracle("A05_delay_split", OUTCOMES.format(performance="performance"))
oracle("A06_top_origins", top("origin", "n", COUNTS.format(column="origin", table="performance")))
oracle(
    "A06_top_destinations",
    top("destination", "n", COUNTS.format(column="destination", table="performance")),
)
oracle("A07_duration_histogram", histogram_of("performance"))
oracle(
    "A08_value_at_risk_by_location", top("location", "value_at_risk", RISK.format(routes="routes"))
)
oracle("A09_daily_volume", COUNTS.format(column="shipping_date", table="performance"))
oracle(
    "A10_busiest_routes",
    f"""
    SELECT * FROM ({BUSIEST.format(routes='routes')})
    ORDER BY total_shipments DESC, route LIMIT 10""",
)
for name, column in (
    ("A11_total_shipments", "total_shipments"),
    ("A12_in_transit", "in_transit"),
    ("A13_delayed_shipments", "delayed_shipments"),
    ("A14_on_time_rate", "on_time_pct"),
    ("A15_value_at_risk", "CAST(value_at_risk AS DOUBLE) AS value_at_risk"),
):
    row = KPIS.format(snapshot="snapshot", performance="performance", routes="routes")
    oracle(name, f"SELECT {column} FROM ({row})")

# Window, sort, top-k, set operations
oracle("W01_latest_event_per_shipment", "SELECT * FROM latest")
oracle(
    "T01_top_counts",
    top("shipping_date", "n", COUNTS.format(column="shipping_date", table="bronze_shipments")),
)
oracle(
    "T02_largest_values",
    top("shipment_id", "declared_value", "SELECT shipment_id, declared_value FROM performance"),
)
oracle("T03_display_order", COUNTS.format(column="shipping_date", table="bronze_shipments"))
oracle(
    "U01_slicer_values",
    "SELECT origin FROM snapshot WHERE origin IS NOT NULL UNION SELECT origin FROM performance "
    "WHERE origin IS NOT NULL",
)

# Streaming
oracle("R01_feed_to_topic", CLEAN_CSV)
oracle(
    "R02_topic_to_bronze",
    TRACKING_TEXT.format(table="bronze_tracking")
    + " UNION ALL "
    + TRACKING_TEXT.format(table="rough_tracking"),
)
oracle(
    "R02_unknown_fields",
    """
    SELECT b.*, props FROM bronze_tracking b JOIN events e ON b.event_id = CAST(e.event_id AS VARCHAR)""",
)
oracle(
    "R02_rejects",
    "SELECT '[' || props || '] ' || event_id AS value FROM events WHERE event_type = 'error'",
)
oracle("R03_replay_tolerance", "SELECT * FROM tracking")

# Named jobs
oracle(
    "G01_silver_shipments",
    """
    SELECT shipment_id, '  ' || priority || chr(9) AS origin, status || ' ' AS destination,
           weight_kg, declared_value, shipping_date
    FROM typed_rough_shipments WHERE shipment_id IS NOT NULL
    QUALIFY row_number() OVER (
      PARTITION BY shipment_id
      ORDER BY shipping_date DESC NULLS LAST, priority DESC NULLS LAST, status DESC NULLS LAST,
               weight_kg DESC NULLS LAST, declared_value DESC NULLS LAST) = 1""",
)
oracle(
    "G02_silver_tracking",
    """
    SELECT * FROM (
      SELECT * FROM typed_rough_tracking
      UNION ALL
      SELECT event_id, shipment_id, event_type, event_timestamp + INTERVAL 1 HOUR, 'HUB-X'
      FROM typed_rough_tracking)
    WHERE event_timestamp IS NOT NULL
    QUALIFY row_number() OVER (
      PARTITION BY event_id ORDER BY event_timestamp DESC, shipment_id DESC, event_type DESC,
      location DESC) = 1""",
)
oracle(
    "G02_incremental_silver",
    """
    SELECT * FROM typed_rough_tracking WHERE event_timestamp IS NOT NULL
    QUALIFY row_number() OVER (
      PARTITION BY event_id ORDER BY event_timestamp DESC, shipment_id DESC, event_type DESC,
      location DESC) = 1""",
)
oracle("G03_delivery_performance", "SELECT * FROM performance")
oracle("G04_route_optimization", "SELECT * FROM routes")
oracle(
    "G04_followed_routes",
    """
    SELECT origin, destination, location, count(shipment_id) AS total_shipments,
           CAST(sum(CAST(declared_value AS DECIMAL(18, 2))) AS DOUBLE) AS total_value_at_risk,
           avg(weight_kg) AS avg_weight_kg
    FROM tracking JOIN (
      SELECT * FROM typed_shipments
      QUALIFY row_number() OVER (
        PARTITION BY shipment_id ORDER BY shipping_date DESC NULLS LAST, origin DESC, destination DESC,
          weight_kg DESC NULLS LAST, declared_value DESC NULLS LAST) = 1) USING (shipment_id)
    GROUP BY origin, destination, location""",
)
oracle("G05_shipment_snapshot", "SELECT * FROM snapshot")
oracle("G06_serving_load", bundle())
for name in ("G07_report", "G07_report_from_cube"):
    oracle(name, long_report())
for name in ("G07_report_sliced", "G07_sliced_from_cube"):
    oracle(
        name,
        long_report(
            sliced("snapshot", "destination = 'MACHINERY'"),
            sliced("performance", "destination = 'MACHINERY'", "is_delayed"),
            sliced("routes", "destination = 'MACHINERY'"),
        ),
    )
oracle(
    "G08_dashboard_load",
    long_report()
    + """
    UNION ALL
    SELECT 'origins', origin, NULL FROM (SELECT DISTINCT origin FROM snapshot)
    UNION ALL
    SELECT 'destinations', destination, NULL FROM (SELECT DISTINCT destination FROM snapshot)""",
)
