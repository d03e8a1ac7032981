"""Values that results depend on."""

from __future__ import annotations

import datetime as dt

# Labels and ids in result rows.
INTERNAL_TABLE = "internal_table"
EXTERNAL_TABLE = "spectrum_table"
VIEW = "view"
INTERNAL_SPACE = "internal"
EXTERNAL_SPACE = "external"
CLUSTER_LOCATION = "cluster"
UNKNOWN_USER = "unknown"
EXTERNAL_ID = -1
UNKNOWN_OID = -1

# Schemas that are not user schemas, and catalog codes.
SYSTEM_SCHEMA = "pg_catalog"
TEMPORARY_SCHEMAS = "pg_temp%"
VIEW_KIND = "v"
INTERNAL_DEPENDENCY = "i"

# Dates and the time zone of snapshot days.
BEGINNING = dt.datetime(1900, 1, 1)
OPEN_END = dt.date(2999, 1, 1)
SIZE_OPEN_END = dt.date(2099, 1, 1)
COLLECTION_START = dt.date(2021, 11, 11)
FIRST_STAGED_DAY = dt.date(2021, 11, 15)
SNAPSHOT_ZONE = "America/New_York"
