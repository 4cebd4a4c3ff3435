"""Column contracts, thresholds and patterns of the feed and of the star schema."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------------
# Names, types, lists, patterns and thresholds below are the feed's and the published
# tables' contract; results only match when they are exactly these.

RAW_FEED = [
    ("OBJECTID", "bigint"),
    ("Case_Summary", "string"),
    ("Case_Status", "string"),
    ("Case_Source", "string"),
    ("Case_Created_Date", "bigint"),
    ("Case_Created_dttm", "string"),
    ("Case_Closed_Date", "bigint"),
    ("Case_Closed_dttm", "string"),
    ("First_Call_Resolution", "string"),
    ("Customer_Zip_Code", "string"),
    ("Incident_Address_1", "string"),
    ("Incident_Address_2", "string"),
    ("Incident_Intersection_1", "string"),
    ("Incident_Intersection_2", "string"),
    ("Incident_Zip_Code", "string"),
    ("Longitude", "double"),
    ("Latitude", "double"),
    ("Agency", "string"),
    ("Division", "string"),
    ("Major_Area", "string"),
    ("Type", "string"),
    ("Topic", "string"),
    ("Council_District", "int"),
    ("Police_District", "int"),
    ("Neighborhood", "string"),
]

DERIVED_FIELDS = [
    ("created_at", "timestamp"),
    ("closed_at", "timestamp"),
    ("is_closed", "boolean"),
    ("resolution_hours", "double"),
    ("is_likely_internal", "boolean"),
    ("has_valid_coordinates", "boolean"),
]

TRIMMED_COLUMNS = [
    "Case_Summary",
    "Case_Status",
    "Case_Source",
    "Incident_Address_1",
    "Incident_Address_2",
    "Agency",
    "Division",
    "Major_Area",
    "Type",
    "Topic",
    "Neighborhood",
]

INTERNAL_SOURCE_PATTERN = "(?i)^email"
INTERNAL_SUMMARY_PATTERN = "(?i)end user digest"
LATITUDE_RANGE = (39.5, 40.0)
LONGITUDE_RANGE = (-105.2, -104.6)

MAX_INTERNAL_RATE = 0.40
MIN_COORDINATE_RATE = 0.90

REQUIRED_BY_LOADER = [
    "OBJECTID",
    "created_at",
    "is_closed",
    "resolution_hours",
    "is_likely_internal",
    "has_valid_coordinates",
]

PREVIEW_COLUMNS = [
    "OBJECTID",
    "created_at",
    "closed_at",
    "is_closed",
    "resolution_hours",
    "Case_Status",
    "Case_Source",
    "Agency",
    "Type",
    "Topic",
    "Neighborhood",
    "Incident_Address_1",
    "is_likely_internal",
    "has_valid_coordinates",
]

PREVIEW_ROWS = 200
TOP_NEIGHBORHOODS = 15
MAP_POINT_LIMIT = 5000
HISTOGRAM_BINS = 20
COLD_START_DAYS = 30

STAR_TABLES = {
    "dim_agency": [("agency_key", "int"), ("agency_name", "string")],
    "dim_service_type": [
        ("service_type_key", "int"),
        ("type_name", "string"),
        ("topic_name", "string"),
    ],
    "dim_neighborhood": [
        ("neighborhood_key", "int"),
        ("neighborhood_name", "string"),
        ("council_district", "int"),
        ("police_district", "int"),
    ],
    "dim_date": [
        ("date_key", "int"),
        ("full_date", "date"),
        ("year", "int"),
        ("month", "int"),
        ("day", "int"),
        ("day_of_week", "int"),
        ("is_weekend", "boolean"),
    ],
    "fact_service_request": [
        ("object_id", "bigint"),
        ("agency_key", "int"),
        ("service_type_key", "int"),
        ("neighborhood_key", "int"),
        ("created_date_key", "int"),
        ("created_at", "timestamp"),
        ("closed_at", "timestamp"),
        ("case_status", "string"),
        ("case_source", "string"),
        ("is_closed", "boolean"),
        ("resolution_hours", "decimal(10,2)"),
        ("is_likely_internal", "boolean"),
        ("has_valid_coordinates", "boolean"),
        ("latitude", "double"),
        ("longitude", "double"),
        ("incident_address", "string"),
        ("loaded_at", "timestamp"),
    ],
}

# On a repeated key the load replaces these columns and keeps every other first-loaded value.
FACT_UPDATED_COLUMNS = ["case_status", "closed_at", "is_closed", "resolution_hours", "loaded_at"]

# Fields of the landing zone's bookkeeping, names of load counts, and units of sizes.
MANIFEST_SCHEMA = (
    "run_id string, run_started_at string, run_finished_at string, source string, "
    "where_clause string, expected_record_count bigint, actual_record_count bigint, "
    "file_count bigint, bytes_written bigint, files array<string>, watermark_before string, "
    "watermark_after string, full_refresh boolean, dry_run boolean, status string"
)
STATE_SCHEMA = "slice string, watermark string, updated_by_run string, updated_at string"
LOAD_COUNTS = {
    "dim_agency": "dim_agency_upserted",
    "dim_service_type": "dim_service_type_upserted",
    "dim_neighborhood": "dim_neighborhood_upserted",
    "dim_date": "dim_date_upserted",
    "fact_service_request": "facts_upserted",
}
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB"]
# --- end of fixed values ----------------------------------------------------------

# Shares of all staged rows above which a batch fails: lines that do not fit the declared schema,
# and rows set apart by row-level checks.
MAX_CORRUPT_RATE = 0.05
MAX_QUARANTINE_RATE = 0.5

# The ordering and coordinate checks read these two, so the gate asks for them as well.
REQUIRED_BY_GATE = [*REQUIRED_BY_LOADER, "closed_at", "Latitude"]

# Hive directory levels of the landing zone, outermost first. They are strings: as
# inferred integers "07" would come back as 7.
LANDING_PARTITIONS = [
    ("ingest_year", "string"),
    ("ingest_month", "string"),
    ("ingest_day", "string"),
    ("run_id", "string"),
]

CORRUPT_COLUMN = "_corrupt_record"


def ddl(columns: list[tuple[str, str]]) -> str:
    """Spark DDL text of a (name, type) list."""
    return ", ".join(f"`{name}` {kind}" for name, kind in columns)


def names(columns: list[tuple[str, str]]) -> list[str]:
    return [name for name, _ in columns]
