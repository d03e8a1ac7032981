"""Inputs of the operators, derived from the driver tables.

One SQL text per input, valid in Spark and DuckDB. Names in braces are driver tables or inputs
further up. Keys are made distinct before they are joined to, so that repeated driver rows do not
multiply. Every driver row of a table an input reads takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import lasting

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "lineitem", "orders", "events", "pages"]

RECIPES: dict[str, str] = {}

# --- users and query log ------------------------------------------------------------------------
# Customers of one market segment are missing from the user list.
RECIPES["users"] = """
SELECT CAST(c_custkey AS INT) AS usesysid, MIN(c_name) AS usename
FROM {customer} WHERE c_mktsegment <> 'FURNITURE' GROUP BY c_custkey
"""
RECIPES["part_names"] = """
SELECT p_partkey, MIN(p_type || '.' || p_brand) AS schema_table FROM {part} GROUP BY p_partkey
"""
# External tables by number: one per nation, and one per region that no event names.
RECIPES["nation_names"] = """
SELECT n_nationkey, MIN(r_name || '.' || n_name) AS schema_table
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey GROUP BY n_nationkey
UNION ALL SELECT 25 + r_regionkey, r_name || '.UNSIZED' FROM {region}
"""
# Each event is a query on one internal and one external table; every fifth one also names a view.
# Three of the views named do not exist.
RECIPES["log_events"] = """
SELECT e.*, e.event_id % (SELECT MAX(p_partkey) + 1 FROM {part}) AS part_key, e.event_id % 25 AS nation_key,
  e.event_id % (SELECT MAX(s_suppkey) + 4 FROM {supplier}) AS view_key
FROM {events} e
"""
RECIPES["log_entries"] = """
SELECT e.event_id, CAST(e.user_id AS INT) AS userid,
  'select ' || e.event_type || ' from ' || p.schema_table || ' join ' || x.schema_table ||
  CASE WHEN e.event_id % 5 = 0 THEN ' join rpt.v_' || CAST(e.view_key AS STRING) ELSE '' END AS querytxt,
  e.ts AS starttime, {ADD_CENTS} AS endtime, CASE WHEN e.event_type = 'error' THEN 1 ELSE 0 END AS aborted
FROM {log_events} e JOIN {part_names} p ON p.p_partkey = e.part_key
JOIN {nation_names} x ON x.n_nationkey = e.nation_key
"""
RECIPES["query_log"] = "SELECT userid, querytxt, starttime, endtime, aborted FROM {log_entries}"
# An archive that overlaps the current log: the entries of failed and purchase events.
RECIPES["log_archive"] = """
SELECT userid, querytxt, starttime, endtime, aborted FROM {log_entries}
WHERE querytxt LIKE 'select error%' OR querytxt LIKE 'select purchase%'
"""
# The stored query history, with the event id as query id.
RECIPES["sql_queries"] = """
SELECT l.event_id AS query_id, l.userid, l.querytxt, COALESCE(u.usename, 'unknown') AS usename,
  {SECONDS} AS duration_second, l.starttime, l.endtime, l.aborted,
  CASE WHEN l.starttime < TIMESTAMP '2024-01-16 00:00:00' THEN CAST('2024-01-16 00:00:00' AS {NTZ})
       ELSE CAST('2024-01-31 00:00:00' AS {NTZ}) END AS created_at
FROM {log_entries} l LEFT JOIN {users} u ON u.usesysid = l.userid
"""

# --- catalogs -----------------------------------------------------------------------------------
RECIPES["internal_raw"] = """
SELECT CAST(MIN(p_partkey) AS INT) AS table_id, ' ' || p_brand AS raw_table, p_type || '  ' AS raw_schema,
  CASE WHEN MIN(p_size) > 3 THEN 'Y' ELSE 'N' END AS encoded, MAX(p_name) AS diststyle, MIN(p_name) AS sortkey1,
  MAX(p_size) AS max_varchar, CASE WHEN MIN(p_size) > 5 THEN 'az64' END AS sortkey1_enc, MIN(p_size) AS sortkey_num
FROM {part} GROUP BY p_type, p_brand
UNION ALL
SELECT CAST(-10 - r_regionkey AS INT), r_name, 'pg_catalog', 'N', 'EVEN', CAST(NULL AS STRING), 1, CAST(NULL AS STRING), 0
FROM {region}
UNION ALL
SELECT CAST(-20 - r_regionkey AS INT), r_name, 'pg_temp_' || CAST(r_regionkey AS STRING), 'N', 'EVEN',
  CAST(NULL AS STRING), 1, CAST(NULL AS STRING), 0
FROM {region}
"""
RECIPES["pg_namespace"] = """
SELECT CAST(10 + MIN(p_partkey) AS INT) AS oid, p_type AS nspname FROM {part} GROUP BY p_type
UNION ALL SELECT 1, 'rpt' UNION ALL SELECT 2, 'pg_catalog' UNION ALL SELECT 3, 'pg_temp_1'
"""
# A table's creation time is the first shipping of its first part; system tables are created with the first order.
RECIPES["class_info"] = """
SELECT i.table_id AS reloid, i.raw_table AS relname, n.oid AS relnamespace, s.first_ship AS relcreationtime
FROM {internal_raw} i JOIN {pg_namespace} n ON n.nspname = TRIM(i.raw_schema)
LEFT JOIN (SELECT l_partkey, MIN(l_shipdate) AS first_ship FROM {lineitem} GROUP BY l_partkey) s
  ON s.l_partkey = i.table_id
UNION ALL
SELECT CAST(-30 - r_regionkey AS INT), r_name, 99, (SELECT MIN(o_orderdate) FROM {orders}) FROM {region}
"""
RECIPES["external_tables"] = """
SELECT n_name || ' ' AS tablename, r_name AS schemaname, 'EXTERNAL' AS tabletype, 'lake/' || LOWER(n_name) AS location,
  'text' AS input_format, 'text' AS output_format, 'lazy' AS serialization_lib,
  'sep=' || CAST(n_nationkey AS STRING) AS serde_parameters, CAST(COUNT(c_custkey) % 2 AS INT) AS compressed,
  'rows=' || CAST(COUNT(c_custkey) AS STRING) AS parameters
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey LEFT JOIN {customer} ON c_nationkey = n_nationkey
GROUP BY n_name, r_name, n_nationkey
UNION ALL
SELECT 'UNSIZED', r_name, 'EXTERNAL', 'lake/unsized', 'text', 'text', 'lazy', 'sep=' || CAST(25 + r_regionkey AS STRING), 0, 'rows=0'
FROM {region}
"""
RECIPES["views"] = """
SELECT s.s_suppkey, 'rpt' AS schemaname, 'v_' || CAST(s.s_suppkey AS STRING) AS viewname,
  'select * from ' || x.schema_table || ' join ' || p.schema_table AS definition, p.schema_table AS internal_table
FROM (SELECT s_suppkey, MIN(s_nationkey) AS s_nationkey FROM {supplier} GROUP BY s_suppkey) s
JOIN {nation_names} x ON x.n_nationkey = s.s_nationkey JOIN {part_names} p ON p.p_partkey = s.s_suppkey
"""
RECIPES["view_definitions"] = "SELECT schemaname, viewname, definition FROM {views}"
RECIPES["pg_class"] = """
SELECT i.table_id AS oid, TRIM(i.raw_table) AS relname, 'r' AS relkind, n.oid AS relnamespace
FROM {internal_raw} i LEFT JOIN {pg_namespace} n ON n.nspname = TRIM(i.raw_schema)
UNION ALL SELECT CAST(1000000000 + s_suppkey AS INT), viewname, 'v', 1 FROM {views}
"""
# A view depends on its table ('n') and itself ('i') through its rule; one system table per region is read by view 0.
RECIPES["pg_depend"] = """
SELECT CAST(1500000000 + v.s_suppkey AS INT) AS objid, i.table_id AS refobjid, 'n' AS deptype
FROM {views} v JOIN {internal_raw} i ON TRIM(i.raw_schema) || '.' || TRIM(i.raw_table) = v.internal_table
UNION ALL SELECT CAST(1500000000 + s_suppkey AS INT), CAST(1000000000 + s_suppkey AS INT), 'i' FROM {views}
UNION ALL SELECT 1500000000, CAST(-10 - r_regionkey AS INT), 'n' FROM {region}
"""

# --- one catalog of all tables, and the days on which it changes ---------------------------------
RECIPES["catalog"] = """
SELECT i.table_id, TRIM(i.raw_table) AS table_name, TRIM(i.raw_schema) AS schema_name,
  TRIM(i.raw_schema) || '.' || TRIM(i.raw_table) AS schema_table, c.relcreationtime AS table_creation_time,
  'internal_table' AS objectsrc, 'cluster' AS location, i.encoded, i.diststyle, i.sortkey1, i.max_varchar,
  i.sortkey1_enc, i.sortkey_num, CAST(NULL AS STRING) AS input_format, CAST(NULL AS STRING) AS output_format,
  CAST(NULL AS STRING) AS serialization_lib, CAST(NULL AS STRING) AS serde_parameters,
  CAST(NULL AS INT) AS compressed, CAST(NULL AS STRING) AS parameters
FROM {internal_raw} i LEFT JOIN {class_info} c ON c.reloid = i.table_id
WHERE i.raw_schema NOT LIKE 'pg^_%' ESCAPE '^'
UNION ALL
SELECT -1, TRIM(tablename), TRIM(schemaname), TRIM(schemaname) || '.' || TRIM(tablename),
  CAST(NULL AS {NTZ}), 'spectrum_table', location, NULL, NULL, NULL, NULL, NULL, NULL,
  input_format, output_format, serialization_lib, serde_parameters, compressed, parameters
FROM {external_tables}
"""
ATTRIBUTES = (
    "table_id, table_name, schema_name, schema_table, table_creation_time, objectsrc, location, encoded, diststyle, "
    "sortkey1, max_varchar, sortkey1_enc, sortkey_num, input_format, output_format, serialization_lib, "
    "serde_parameters, compressed, parameters"
)
# Next day: tables sorted by a blue or small thing are re-encoded, promo tables whose largest part has size 50 and
# one external schema's compressed tables are gone, and each region brings a new table.
RECIPES["catalog_next"] = """
SELECT table_id, table_name, schema_name, schema_table, table_creation_time, objectsrc, location,
  CASE WHEN sortkey1 LIKE 'b%' OR sortkey1 LIKE 's%' THEN 'R' ELSE encoded END AS encoded, diststyle,
  sortkey1, max_varchar, sortkey1_enc, sortkey_num, input_format, output_format, serialization_lib,
  serde_parameters, compressed, parameters
FROM {catalog}
WHERE NOT (schema_name = 'PROMO' AND max_varchar >= 45) AND NOT (schema_name = 'ASIA' AND COALESCE(compressed, 0) = 1)
UNION ALL
SELECT CAST(900000000 + r_regionkey AS INT), r_name, 'NEW', 'NEW.' || r_name, CAST('2024-01-16 08:00:00' AS {NTZ}),
  'internal_table', 'cluster', 'Y', 'EVEN', NULL, NULL, NULL, 0, NULL, NULL, NULL, NULL, NULL, NULL
FROM {region}
"""
# The stored history: everything from January 1st, the changes of the next day from the 16th.
RECIPES["tables"] = """
SELECT DATE '2024-01-01' AS start_date,
  CASE WHEN n.schema_table IS NULL OR n.encoded <> c.encoded THEN DATE '2024-01-15' ELSE DATE '2999-01-01' END AS end_date,
  n.schema_table IS NULL OR NOT (n.encoded <> c.encoded) OR n.encoded IS NULL AS most_recent, c.*,
  CAST('2024-01-01 06:00:00' AS {NTZ}) AS created_at
FROM {catalog} c LEFT JOIN (SELECT schema_table, encoded FROM {catalog_next}) n ON n.schema_table = c.schema_table
UNION ALL
SELECT DATE '2024-01-16', DATE '2999-01-01', TRUE, n.*, CAST('2024-01-16 06:00:00' AS {NTZ})
FROM {catalog_next} n LEFT JOIN (SELECT schema_table, encoded AS old FROM {catalog}) c ON c.schema_table = n.schema_table
WHERE c.schema_table IS NULL OR c.old <> n.encoded
"""
RECIPES["tables"] = RECIPES["tables"].replace(
    "n.*", ", ".join(f"n.{a}" for a in ATTRIBUTES.split(", "))
).replace("c.*", ", ".join(f"c.{a}" for a in ATTRIBUTES.split(", ")))

# --- dependencies in SQL, as inputs of the operators that follow them ------------------------------
RECIPES["object_deps"] = """
SELECT 'rpt.' || viewname AS dependent_schema_objectname, internal_table AS src_schema_table,
  'internal_table' AS src_objectsrc, i.table_id, CAST(1000000000 + s_suppkey AS INT) AS dependent_oid,
  'view' AS dependent_objectsrc
FROM {views} JOIN {internal_raw} i ON TRIM(i.raw_schema) || '.' || TRIM(i.raw_table) = internal_table
UNION ALL
SELECT 'rpt.' || viewname, x.schema_table, 'spectrum_table', -1, CAST(1000000000 + s.s_suppkey AS INT), 'view'
FROM {views} v JOIN (SELECT s_suppkey, MIN(s_nationkey) AS nation FROM {supplier} GROUP BY s_suppkey) s
  ON s.s_suppkey = v.s_suppkey JOIN {nation_names} x ON x.n_nationkey = s.nation
"""
# Each query uses its internal and its external table.
RECIPES["query_deps"] = """
SELECT SUBSTRING(t.schema_table, POSITION('.' IN t.schema_table) + 1) AS table_name,
  SUBSTRING(t.schema_table, 1, POSITION('.' IN t.schema_table) - 1) AS schema_name, t.schema_table, t.objectsrc,
  q.query_id, q.querytxt, q.usename, q.duration_second, q.starttime, q.endtime, q.aborted
FROM {sql_queries} q JOIN (
  SELECT e.event_id, p.schema_table, 'internal_table' AS objectsrc
  FROM {log_events} e JOIN {part_names} p ON p.p_partkey = e.part_key
  UNION ALL
  SELECT e.event_id, x.schema_table, 'spectrum_table'
  FROM {log_events} e JOIN {nation_names} x ON x.n_nationkey = e.nation_key
) t ON t.event_id = q.query_id
"""

# --- sizes ----------------------------------------------------------------------------------------
RECIPES["table_space_source"] = """
SELECT CAST(MIN(p_partkey) AS INT) AS table_id, p_type AS raw_schema, p_brand AS raw_table,
  CAST(SUM(p_size) AS BIGINT) AS size, CAST(MAX(p_size) AS DECIMAL(10,4)) AS pct_used, CAST(MIN(p_size) AS BIGINT) AS empty,
  CAST(MAX(p_size) AS DECIMAL(5,2)) AS unsorted, CAST(MIN(p_size) AS DECIMAL(5,2)) AS stats_off,
  CAST(COUNT(*) * 1250 AS DECIMAL(38,0)) AS tbl_rows, CAST(MIN(p_size) AS DECIMAL(19,2)) AS skew_sortkey1,
  CAST(MAX(p_size) AS DECIMAL(19,2)) AS skew_rows, CAST(COUNT(*) AS DECIMAL(38,0)) AS estimated_visible_rows,
  MIN(p_name) AS risk_event, CAST(MAX(p_size) AS DECIMAL(12,2)) AS vacuum_sort_benefit
FROM {part} GROUP BY p_type, p_brand
"""
# The stored snapshots: a table's size on a day is the number of that day's queries on it.
RECIPES["internal_space"] = """
SELECT CAST(e.ts AS DATE) AS snapshot_date, t.table_id, t.schema_table,
  CAST(COUNT(*) * 51200 AS DECIMAL(25,1)) AS tablesize_kb, CAST(MAX(t.sortkey_num) AS DECIMAL(10,4)) AS pct_used,
  CAST(COUNT(*) AS BIGINT) AS empty, CAST(NULL AS DECIMAL(5,2)) AS unsorted, CAST(NULL AS DECIMAL(5,2)) AS stats_off,
  CAST(COUNT(*) * 1250 AS DECIMAL(38,0)) AS tbl_rows, CAST(NULL AS DECIMAL(19,2)) AS skew_sortkey1,
  CAST(NULL AS DECIMAL(19,2)) AS skew_rows, CAST(COUNT(*) AS DECIMAL(38,0)) AS estimated_visible_rows,
  CAST(NULL AS STRING) AS risk_event, CAST(NULL AS DECIMAL(12,2)) AS vacuum_sort_benefit,
  CAST('2024-01-31 00:00:00' AS {NTZ}) AS created_at
FROM {log_events} e JOIN {part_names} p ON p.p_partkey = e.part_key
JOIN {catalog} t ON t.schema_table = p.schema_table
GROUP BY CAST(e.ts AS DATE), t.table_id, t.schema_table
"""
# Sizes of external tables arrive with every event on them.
RECIPES["external_sizes"] = """
SELECT x.schema_table, CAST(FLOOR(e.value * 100) AS INT) AS tablesize_kb, e.ts AS created_at
FROM {log_events} e JOIN {nation_names} x ON x.n_nationkey = e.nation_key
"""
RECIPES["external_space"] = """
SELECT CAST({NEW_YORK} AS DATE) AS snapshot_date, -1 AS table_id, schema_table, tablesize_kb,
  CAST('2024-01-31 00:00:00' AS {NTZ}) AS created_at
FROM {external_sizes} s
"""
RECIPES["size_excludes"] = """
SELECT x.schema_table, o_orderpriority AS exclude_reason, o_orderdate AS created_at
FROM {orders} JOIN {nation_names} x ON x.n_nationkey = o_custkey % 30
"""
RECIPES["calendar"] = "SELECT DISTINCT CAST(ts AS DATE) AS date FROM {events}"

# --- names in long texts --------------------------------------------------------------------------
RECIPES["hosts"] = """
SELECT DISTINCT REGEXP_EXTRACT(url, '//([^/]+)/', 1) AS host FROM {pages}
WHERE REGEXP_EXTRACT(url, '//([^/]+)/', 1) LIKE '%.%'
"""

# The expressions that the two engines spell differently.
DIALECT = {
    "spark": {
        "ADD_CENTS": "TIMESTAMPADD(MICROSECOND, CAST(ROUND(e.value * 100) AS BIGINT) * 10000, e.ts)",
        "SECONDS": "UNIX_TIMESTAMP(l.endtime) - UNIX_TIMESTAMP(l.starttime)",
        "NEW_YORK": "CONVERT_TIMEZONE('UTC', 'America/New_York', s.created_at)",
        "NTZ": "TIMESTAMP_NTZ",
    },
    "duckdb": {
        "ADD_CENTS": "e.ts + TO_MICROSECONDS(CAST(ROUND(e.value * 100) AS BIGINT) * 10000)",
        "SECONDS": "DATE_DIFF('second', l.starttime, l.endtime)",
        "NEW_YORK": "(s.created_at AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'",
        "NTZ": "TIMESTAMP",
    },
}


# Catalog-sized inputs that many queries read: written once per session, like the stored tables they stand for, also when
# the first to read them is a run that removes its own intermediate results.
STORED = {"internal_raw", "class_info", "catalog", "catalog_next", "tables", "object_deps", "part_names", "nation_names"}


class Inputs:
    """The inputs over one data folder, built on first use."""

    _open: dict[tuple[str, str], Inputs] = {}

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self._frames: dict[str, DataFrame] = {}

    @classmethod
    def over(cls, spark: SparkSession, root: str) -> Inputs:
        """The session's inputs over ``root``."""
        return cls._open.setdefault((spark.sparkContext.applicationId, root), cls(spark, root))

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name in RECIPES:
                text = RECIPES[name]
                used = {n: self[n] for n in [*DRIVER_TABLES, *RECIPES] if "{" + n + "}" in text}
                for key, expression in DIALECT["spark"].items():
                    text = text.replace("{" + key + "}", expression)
                frame = self.spark.sql(text, **used)
                self._frames[name] = lasting(frame) if name in STORED else frame
            else:
                self._frames[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._frames[name]


def needed(names: list[str]) -> list[str]:
    """The recipes behind ``names``, each after those it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in RECIPES:
            if "{" + other + "}" in RECIPES[name]:
                visit(other)
        if name not in order:
            order.append(name)

    for name in names:
        visit(name)
    return order


def duckdb_ctes(names: list[str]) -> list[str]:
    """Common table expressions that build ``names`` in DuckDB."""
    ctes = []
    for name in needed(names):
        text = RECIPES[name]
        for key, expression in DIALECT["duckdb"].items():
            text = text.replace("{" + key + "}", expression)
        for other in RECIPES:
            text = text.replace("{" + other + "}", f"in_{other}")
        for table in DRIVER_TABLES:
            text = text.replace("{" + table + "}", table)
        ctes.append(f"in_{name} AS MATERIALIZED ({text.strip()})")
    return ctes
