"""Declared schemas of every input and every result table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

INPUTS: dict[str, str] = {
    "query_log": "userid int, querytxt string, starttime timestamp_ntz, endtime timestamp_ntz, aborted int",
    "users": "usesysid int, usename string",
    "internal_tables": (
        "table_id int, `table` string, `schema` string, encoded string, diststyle string, sortkey1 string, "
        "max_varchar int, sortkey1_enc string, sortkey_num int"
    ),
    "class_info": "reloid int, relname string, relnamespace int, relcreationtime timestamp_ntz",
    "external_tables": (
        "tablename string, schemaname string, tabletype string, location string, input_format string, "
        "output_format string, serialization_lib string, serde_parameters string, compressed int, parameters string"
    ),
    "pg_class": "oid int, relname string, relkind string, relnamespace int",
    "pg_depend": "objid int, refobjid int, deptype string",
    "pg_namespace": "oid int, nspname string",
    "view_definitions": "schemaname string, viewname string, definition string",
    "table_space_source": (
        "table_id int, `schema` string, `table` string, size bigint, pct_used decimal(10,4), empty bigint, "
        "unsorted decimal(5,2), stats_off decimal(5,2), tbl_rows decimal(38,0), skew_sortkey1 decimal(19,2), "
        "skew_rows decimal(19,2), estimated_visible_rows decimal(38,0), risk_event string, "
        "vacuum_sort_benefit decimal(12,2)"
    ),
    "external_sizes": "schema_table string, tablesize_kb int, created_at timestamp_ntz",
    "size_excludes": "schema_table string, exclude_reason string, created_at timestamp_ntz",
    "calendar": "date date",
}

# The attributes whose change opens a new version in the table history.
TABLE_ATTRIBUTES = [
    "table_id", "table_name", "schema_name", "schema_table", "table_creation_time", "objectsrc", "location",
    "encoded", "diststyle", "sortkey1", "max_varchar", "sortkey1_enc", "sortkey_num", "input_format",
    "output_format", "serialization_lib", "serde_parameters", "compressed", "parameters",
]

TARGETS: dict[str, str] = {
    "sql_queries": (
        "query_id bigint, userid int, querytxt string, usename string, duration_second bigint, "
        "starttime timestamp_ntz, endtime timestamp_ntz, aborted int, created_at timestamp_ntz"
    ),
    "tables": (
        "start_date date, end_date date, most_recent boolean, table_id int, table_name string, schema_name string, "
        "schema_table string, table_creation_time timestamp_ntz, objectsrc string, location string, encoded string, "
        "diststyle string, sortkey1 string, max_varchar int, sortkey1_enc string, sortkey_num int, "
        "input_format string, output_format string, serialization_lib string, serde_parameters string, "
        "compressed int, parameters string, created_at timestamp_ntz"
    ),
    "object_dependencies": (
        "dependent_schema_objectname string, src_schema_table string, src_objectsrc string, table_id int, "
        "dependent_oid int, dependent_objectsrc string"
    ),
    "query_dependencies": (
        "table_name string, schema_name string, schema_table string, objectsrc string, query_id bigint, "
        "querytxt string, usename string, duration_second bigint, starttime timestamp_ntz, endtime timestamp_ntz, "
        "aborted int"
    ),
    "query_matches": "query_id bigint, name string, match_location int, name_length int, matched_at timestamp_ntz",
    "matched_names": "name string, since timestamp_ntz",
    "internal_table_space": (
        "snapshot_date date, table_id int, schema_table string, tablesize_kb decimal(25,1), pct_used decimal(10,4), "
        "empty bigint, unsorted decimal(5,2), stats_off decimal(5,2), tbl_rows decimal(38,0), "
        "skew_sortkey1 decimal(19,2), skew_rows decimal(19,2), estimated_visible_rows decimal(38,0), "
        "risk_event string, vacuum_sort_benefit decimal(12,2), created_at timestamp_ntz"
    ),
    "spectrum_table_space": (
        "snapshot_date date, table_id int, schema_table string, tablesize_kb int, created_at timestamp_ntz"
    ),
    "table_stats_byday": (
        "snapshot_date date, schema_table string, table_creation_date date, objectsrc string, tablesize_kb double, "
        "tbl_rows_mm decimal(38,4), cnt_query bigint, cntd_usename bigint, sum_aborted bigint, "
        "min_query_duration_sec bigint, max_query_duration_sec bigint, avg_query_duration_sec bigint, "
        "size_exclude_reason string, table_id int, encoded string, diststyle string, sortkey_num int, "
        "input_format string, output_format string, parameters string"
    ),
}


def empty_target(spark: SparkSession, name: str) -> DataFrame:
    """The state of a result table before its first load."""
    return spark.createDataFrame([], StructType.fromDDL(TARGETS[name]))
