"""Relations derived from the base tables, as SQL text that Spark and DuckDB both run.

Text is written once with double-quoted names; ``for_spark`` swaps the quotes and marks the
base tables as parameters of ``spark.sql``.
"""

from __future__ import annotations

import re

BASE_TABLES = ["orders", "customer", "events", "lineitem", "part"]

CLAIMS_RAW = """
WITH k AS (SELECT o.o_orderkey AS ok, o.o_totalprice AS tp, o.o_orderdate AS od, c.c_nationkey AS nk, c.c_acctbal AS ab, c.c_mktsegment AS seg,
   (o_orderkey*7919 + o_custkey*104729) % 1000 AS h1, (o_orderkey*6151 + o_custkey*769) % 1000 AS h2, (o_orderkey*3571 + o_custkey*389) % 1000 AS h3
   FROM orders o JOIN customer c ON o.o_custkey=c.c_custkey),
 f AS (SELECT *, h1 < 240 AS fr, CASE WHEN h1 < 240 AND h2 % 10 < 7 THEN tp * (4 + h2 % 7) ELSE tp END AS amt FROM k)
SELECT
  CASE WHEN ok % 89 = 0 THEN NULL WHEN fr AND h2 % 2 = 0 THEN h2 % 12 ELSE h2 % 240 END AS months_as_customer,
  CASE WHEN ok % 97 = 0 THEN NULL WHEN h1 % 200 = 7 THEN 150 ELSE 18 + h1 % 57 END AS age,
  concat('POL', lpad(CAST(CASE WHEN ok % 101 = 100 THEN ok-1 ELSE ok END AS VARCHAR(20)), 8, '0')) AS policy_number,
  CASE nk % 5 WHEN 0 THEN 'OH' WHEN 1 THEN ' in' WHEN 2 THEN 'IL ' WHEN 3 THEN 'pa' ELSE 'NY' END AS policy_state,
  CASE h3 % 3 WHEN 0 THEN '100/300' WHEN 1 THEN '250/500' ELSE '500/1000' END AS policy_csl,
  500 * (1 + h2 % 4) AS policy_deductable,
  CASE WHEN ok % 211 = 0 THEN 0.0E0 ELSE abs(ab) END AS policy_annual_premium,
  CASE WHEN h3 % 2 = 0 THEN 'm' ELSE 'F' END AS insured_sex,
  CASE h1 % 4 WHEN 0 THEN 'High School' WHEN 1 THEN 'BS' WHEN 2 THEN 'MS' ELSE 'PhD' END AS insured_education_level,
  seg AS insured_occupation,
  CAST(h1 * 50 AS DOUBLE) AS "capital-gains",
  CAST(h2 * 30 AS DOUBLE) AS "capital-loss",
  CASE h2 % 8 WHEN 0 THEN 'Single Vehicle Collision' WHEN 1 THEN 'Multi-vehicle Collision' WHEN 2 THEN 'Vehicle Rollover' WHEN 3 THEN 'Hit and Run' WHEN 4 THEN 'Parked Car Damage' WHEN 5 THEN 'Broken Windshield' WHEN 6 THEN 'Fire Damage' ELSE '3rd party theft' END AS incident_type,
  CASE WHEN ok % 79 = 0 THEN NULL WHEN h3 % 3 = 0 THEN 'Front' WHEN h3 % 3 = 1 THEN 'Rear' ELSE 'Side' END AS collision_type,
  CASE WHEN ok % 83 = 0 THEN NULL WHEN h1 % 4 = 0 THEN 'Trivial Damage' WHEN h1 % 4 = 1 THEN 'minor damage' WHEN h1 % 4 = 2 THEN 'Major Damage' ELSE 'TOTAL LOSS ' END AS incident_severity,
  CASE WHEN fr AND h3 % 10 < 4 THEN 22 + h3 % 2 ELSE h3 % 24 END AS incident_hour_of_the_day,
  1 + CASE WHEN h2 % 10 < 6 THEN 0 WHEN h2 % 10 < 9 THEN 1 ELSE 2 END AS number_of_vehicles_involved,
  CASE WHEN h1 % 10 < 7 THEN 'YES' ELSE 'NO' END AS property_damage,
  CASE WHEN h3 % 20 < 10 THEN 0 WHEN h3 % 20 < 16 THEN 1 WHEN h3 % 20 < 19 THEN 2 ELSE 3 END AS bodily_injuries,
  CASE WHEN fr AND h3 % 10 < 6 THEN 0 WHEN h2 % 10 < 4 THEN 0 WHEN h2 % 10 < 8 THEN 1 ELSE 2 END AS witnesses,
  CASE WHEN h2 % 10 < 6 THEN 'YES' ELSE 'NO' END AS police_report_available,
  amt AS total_claim_amount,
  CASE WHEN ok % 73 = 0 THEN NULL ELSE amt * (h3 % 30) / 100 END AS injury_claim,
  amt * (10 + h2 % 31) / 100 AS property_claim,
  amt * (40 + h1 % 41) / 100 AS vehicle_claim,
  CASE h3 % 9 WHEN 0 THEN 'Honda' WHEN 1 THEN 'Toyota' WHEN 2 THEN 'Ford' WHEN 3 THEN 'Chevrolet' WHEN 4 THEN 'BMW' WHEN 5 THEN 'Mercedes' WHEN 6 THEN 'Audi' WHEN 7 THEN 'Nissan' ELSE 'Mazda' END AS auto_make,
  2005 + h3 % 20 AS auto_year,
  CASE WHEN fr THEN 'Y' ELSE 'N' END AS fraud_reported,
  CAST(NULL AS VARCHAR(1)) AS "_c39",
  od AS incident_date
FROM f
"""

RUN_LOG = """
SELECT event_id AS run_id, event_type AS pipeline_name, ts AS start_time,
  CASE WHEN event_type = 'view' THEN 'running' WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
  CASE WHEN event_type = 'view' THEN NULL ELSE value END AS execution_time_seconds,
  1000 + user_id * 10 AS rows_extracted, 1000 + user_id * 9 AS rows_transformed, 1000 + user_id * 8 AS rows_loaded
FROM events
"""

SCORED = """
SELECT policy_number, incident_date, CASE WHEN fraud_reported = 'Y' THEN 1 ELSE 0 END AS label,
  (60 + CASE WHEN bodily_injuries > 0 AND witnesses = 0 THEN 250 ELSE 0 END
      + CASE WHEN total_claim_amount > 500000 THEN 350 ELSE 0 END
      + CASE WHEN months_as_customer < 12 THEN 150 ELSE 0 END
      + CASE WHEN incident_hour_of_the_day >= 22 THEN 100 ELSE 0 END
      + policy_deductable / 100) / 1000.0E0 AS probability
FROM claims_raw
"""

DRIFT_REF = """
SELECT * FROM claims_raw WHERE incident_date < {ntz} '1998-07-01 00:00:00'
"""

_MOVED = {
    "total_claim_amount": "total_claim_amount * 1.3E0",
    "incident_severity": "CASE WHEN incident_hour_of_the_day >= 22 THEN 'Write Off' ELSE incident_severity END",
}
_RAW_NAMES = re.findall(r' AS ("[^"]+"|\w+),?$', CLAIMS_RAW.split("FROM f\n")[0].split("SELECT\n")[1], re.M)
DRIFT_NEW = "SELECT " + ", ".join(f"{_MOVED[c]} AS {c}" if c in _MOVED else c for c in _RAW_NAMES) + (
    " FROM claims_raw WHERE incident_date >= {ntz} '1998-07-01 00:00:00'")

FEATURE_WRITES = """
SELECT 'claims' AS feature_group, CAST(o_custkey AS VARCHAR(20)) AS entity_id, o_orderdate AS stored_at, o_orderkey AS seq, o_totalprice AS total_claim_amount
FROM orders
"""

LINEAGE_EDGES = """
SELECT concat('part:', CAST(l_partkey AS VARCHAR(20))) AS from_node, concat('order:', CAST(l_orderkey AS VARCHAR(20))) AS to_node, 'aggregate' AS transformation
FROM lineitem
"""

# One row per write of a lineage node: parts once, orders once when placed and again per day shipped.
LINEAGE_NODE_WRITES = """
SELECT concat('part:', CAST(p_partkey AS VARCHAR(20))) AS node_id, p_name AS name, 'database' AS source, {ntz} '1990-01-01 00:00:00' AS written_at FROM part
UNION ALL
SELECT concat('order:', CAST(o_orderkey AS VARCHAR(20))), o_orderpriority, 'csv', o_orderdate FROM orders
UNION ALL
SELECT concat('order:', CAST(l_orderkey AS VARCHAR(20))), concat('shipped-', l_shipmode_day), 'stream', l_shipdate
FROM (SELECT l_orderkey, l_shipdate, CAST(max(l_linenumber) AS VARCHAR(20)) AS l_shipmode_day FROM lineitem GROUP BY l_orderkey, l_shipdate) s
"""

# One drift check per calendar month of the claims: distance of its fraud rate from the overall rate.
DRIFT_LOG = """
WITH m AS (SELECT date_trunc('month', incident_date) AS checked_at, count(*) AS n,
             sum(CASE WHEN fraud_reported = 'Y' THEN 1 ELSE 0 END) AS fr
           FROM claims_raw GROUP BY date_trunc('month', incident_date)),
 d AS (SELECT checked_at, abs(fr * 1.0E0 / n - sum(fr) OVER () * 1.0E0 / sum(n) OVER ()) AS overall_drift FROM m)
SELECT checked_at, overall_drift,
  CASE WHEN overall_drift > 0.25 THEN 'critical' WHEN overall_drift > 0.15 THEN 'high'
       WHEN overall_drift > 0.05 THEN 'moderate' ELSE 'none' END AS severity
FROM d
"""

# name -> (text, relations it reads)
RELATIONS = {
    "claims_raw": (CLAIMS_RAW, ["orders", "customer"]),
    "run_log": (RUN_LOG, ["events"]),
    "scored": (SCORED, ["claims_raw"]),
    "drift_ref": (DRIFT_REF, ["claims_raw"]),
    "drift_new": (DRIFT_NEW, ["claims_raw"]),
    "feature_writes": (FEATURE_WRITES, ["orders"]),
    "lineage_edges": (LINEAGE_EDGES, ["lineitem"]),
    "lineage_node_writes": (LINEAGE_NODE_WRITES, ["part", "orders", "lineitem"]),
    "drift_log": (DRIFT_LOG, ["claims_raw"]),
}


def for_spark(name: str) -> str:
    text, reads = RELATIONS[name]
    text = text.replace("{ntz}", "TIMESTAMP_NTZ").replace('"', "`")
    for read in reads:
        text = re.sub(rf"\b(FROM|JOIN) {read}\b", rf"\1 {{{read}}}", text)
    return text


def for_duckdb(name: str) -> str:
    return RELATIONS[name][0].replace("{ntz}", "TIMESTAMP").strip()
