"""Edges from views to tables and from queries to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import qualified
from tidemark.operators.joins import lookup_join
from tidemark.operators.matching import contains_join, longest_match
from tidemark.session import no_larger
from tidemark.sources.fixed_values import (
    EXTERNAL_TABLE,
    INTERNAL_DEPENDENCY,
    INTERNAL_TABLE,
    SYSTEM_SCHEMA,
    UNKNOWN_OID,
    VIEW,
    VIEW_KIND,
)

EDGE_COLUMNS = [
    "dependent_schema_objectname", "src_schema_table", "src_objectsrc", "table_id", "dependent_oid",
    "dependent_objectsrc",
]
QUERY_COLUMNS = ["query_id", "querytxt", "usename", "duration_second", "starttime", "endtime", "aborted"]


def view_dependency(pg_class: DataFrame, pg_depend: DataFrame, pg_namespace: DataFrame) -> DataFrame:
    """Views and the objects they read, through the rewrite rule both depend on.

    Both sides are made distinct before they meet on the rule, so repeated entries do not multiply.
    These joins stay plain: catalogs are small beside the log, and adaptive execution splits a rule
    or a schema that holds many rows.
    """
    namespaces = pg_namespace.select(F.col("oid").alias("relnamespace"), "nspname")
    objects = pg_class.join(namespaces, "relnamespace", "left")
    source = objects.select(
        F.col("oid").alias("src_oid"),
        F.col("nspname").alias("src_schemaname"),
        F.col("relname").alias("src_objectname"),
    )
    view = objects.where(F.col("relkind") == VIEW_KIND).select(
        F.col("oid").alias("dependent_viewoid"),
        F.col("nspname").alias("dependent_schemaname"),
        F.col("relname").alias("dependent_objectname"),
    )
    reads = pg_depend.select("objid", F.col("refobjid").alias("src_oid")).distinct()
    rules = (
        pg_depend.where(F.col("deptype") == INTERNAL_DEPENDENCY).select("objid", F.col("refobjid").alias("dependent_viewoid")).distinct()
    )
    pairs = reads.join(rules.join(view, "dependent_viewoid"), "objid")
    found = pairs.where(F.col("src_oid") != F.col("dependent_viewoid")).join(source, "src_oid")
    return found.select(*source.columns, *view.columns).distinct()


def internal_view_edges(dependencies: DataFrame) -> DataFrame:
    """View edges to internal tables, with qualified names; catalog schemas drop out."""
    return dependencies.where(~F.col("src_schemaname").isin(SYSTEM_SCHEMA)).select(
        F.col("src_oid").cast("int").alias("table_id"),
        "src_schemaname",
        "src_objectname",
        qualified(F.col("src_schemaname"), F.col("src_objectname")).alias("src_schema_table"),
        F.col("dependent_viewoid").cast("int").alias("dependent_oid"),
        "dependent_schemaname",
        "dependent_objectname",
        qualified(F.col("dependent_schemaname"), F.col("dependent_objectname")).alias("dependent_schema_objectname"),
    )


def view_text_match(view_defs: DataFrame, tables: DataFrame) -> DataFrame:
    """External tables named in view definitions, all matches."""
    external = tables.where(F.col("most_recent") & (F.col("objectsrc") == EXTERNAL_TABLE)).select(
        F.col("table_id").cast("int").alias("table_id"),
        F.col("schema_name").alias("src_schemaname"),
        F.col("table_name").alias("src_objectname"),
        F.col("schema_table").alias("src_schema_table"),
    )
    view = ["dependent_schemaname", "dependent_objectname"]
    texts = view_defs.select(
        F.col("schemaname").alias(view[0]), F.col("viewname").alias(view[1]), F.col("definition").alias("text")
    )
    matches = contains_join(external, texts, "src_schema_table", "text", view)
    matches = matches.withColumnsRenamed({"name": "src_schema_table", "name_length": "schema_table_length"})
    return lookup_join(matches, no_larger(external, tables), ["src_schema_table"]).select(
        *external.columns,
        F.lit(UNKNOWN_OID).alias("dependent_oid"),
        *view,
        qualified(F.col(view[0]), F.col(view[1])).alias("dependent_schema_objectname"),
        "match_location",
        "schema_table_length",
    )


def external_view_edges(view_defs: DataFrame, tables: DataFrame, internal_edges: DataFrame) -> DataFrame:
    """View edges to external tables: longest match per place, view ids filled in where known."""
    matches = longest_match(
        view_text_match(view_defs, tables), ["dependent_schema_objectname"], "schema_table_length"
    )
    return view_oid_backfill(matches, internal_edges)


def view_oid_backfill(external_edges: DataFrame, internal_edges: DataFrame) -> DataFrame:
    """Give external edges the view id that the view's internal edges carry; others keep theirs."""
    known = internal_edges.groupBy("dependent_schema_objectname").agg(F.min("dependent_oid").alias("_oid"))
    filled = external_edges.join(known, "dependent_schema_objectname", "left")
    return filled.withColumn("dependent_oid", F.coalesce("_oid", "dependent_oid")).drop("_oid")


def object_dependencies(internal_edges: DataFrame, external_edges: DataFrame) -> DataFrame:
    """All view edges in one list."""

    def edges(df: DataFrame, source: str) -> DataFrame:
        return df.withColumn("src_objectsrc", F.lit(source)).withColumn("dependent_objectsrc", F.lit(VIEW)).select(
            *EDGE_COLUMNS
        )

    return edges(internal_edges, INTERNAL_TABLE).unionByName(edges(external_edges, EXTERNAL_TABLE))


def dependency_lookup(edges: DataFrame, view: str) -> DataFrame:
    """The edges of one view."""
    return (
        edges.where(F.col("dependent_schema_objectname") == view)
        .select(
            "dependent_objectsrc", "dependent_schema_objectname", "src_objectsrc", "src_schema_table", "table_id",
            "dependent_oid",
        )
        .orderBy("dependent_schema_objectname", "src_objectsrc", "src_schema_table")
    )


def named_targets(tables: DataFrame, object_deps: DataFrame) -> DataFrame:
    """What each name that a query may use stands for: a table itself, a view its source tables."""
    own = tables.where("most_recent").select(
        F.col("schema_table").alias("name"), F.col("schema_table").alias("schema_table")
    )
    through = object_deps.select(
        F.col("dependent_schema_objectname").alias("name"), F.col("src_schema_table").alias("schema_table")
    )
    return no_larger(own.unionByName(through).distinct(), tables, object_deps)


def query_text_match(queries: DataFrame, tables: DataFrame, object_deps: DataFrame) -> DataFrame:
    """Tables that query texts name, directly or through a view, all matches, narrow columns.

    The length is that of the name found, for a view that of the view's name.
    """
    targets = named_targets(tables, object_deps)
    matches = contains_join(targets, queries, "name", "querytxt", ["query_id"])
    return (
        lookup_join(matches, targets, ["name"])
        .select("schema_table", "query_id", "match_location", F.col("name_length").alias("schema_table_length"))
        .distinct()
    )


def query_dependencies(matches: DataFrame, tables: DataFrame, queries: DataFrame) -> DataFrame:
    """Matches of (schema_table, query_id) with the table and query columns, each pair once.

    Distinct before the wide columns join: ``query_id`` identifies a query.
    """
    current = tables.where("most_recent").select("table_name", "schema_name", "schema_table", "objectsrc")
    pairs = matches.select("query_id", "schema_table").distinct()
    narrow = lookup_join(pairs, no_larger(current, tables), ["schema_table"])
    return narrow.join(queries.select(*QUERY_COLUMNS), "query_id").select(*current.columns, *QUERY_COLUMNS)


def attribute_matches(matches: DataFrame, queries: DataFrame, tables: DataFrame, object_deps: DataFrame) -> DataFrame:
    """Names found in queries (query_id, name, match_location, name_length) to :func:`query_dependencies`.

    The longest name per place is chosen before views unfold into their tables, so the choice runs
    over names, not over edges. Everything up to the join with the log is partitioned by query.
    """
    names = longest_match(matches, ["query_id"])
    used = lookup_join(names.select("query_id", "name"), named_targets(tables, object_deps), ["name"])
    return query_dependencies(used, tables, queries)


def attribute_queries(queries: DataFrame, tables: DataFrame, object_deps: DataFrame) -> DataFrame:
    """Query log to :func:`query_dependencies` in one go; a run that knows earlier ones takes ``increments.matches_after``."""
    matches = contains_join(named_targets(tables, object_deps), queries, "name", "querytxt", ["query_id"])
    return attribute_matches(matches, queries, tables, object_deps)
