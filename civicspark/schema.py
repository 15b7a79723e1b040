"""Schemas and fixed values of the service-request data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Raw records arrive as text: every field of a landed page is a nullable string.
RAW_COLUMNS = [
    "unique_key",
    "complaint_type",
    "borough",
    "created_date",
    "closed_date",
    "agency",
    "descriptor",
    "incident_zip",
    "latitude",
    "longitude",
]
RAW_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in RAW_COLUMNS])

KEY_COLUMN = "unique_key"
DATE_COLUMNS = ["created_date", "closed_date"]
COORDINATE_PAIRS = [
    ("latitude", "longitude"),
    ("incident_address_latitude", "incident_address_longitude"),
]
RESPONSE_COLUMN = "response_time_hours"
UNKNOWN = "UNKNOWN"

# ---------------------------------------------------------------------------
# Fixed values. These must stay exactly as written for results to agree with
# the behaviour being reproduced (domain map, bounds, limits, column lists).
# ---------------------------------------------------------------------------

# Required columns after cleaning, in this order.
REQUIRED_COLUMNS = [
    "unique_key",
    "created_date",
    "closed_date",
    "complaint_type",
    "agency",
    "borough",
    "descriptor",
    "incident_zip",
    "latitude",
    "longitude",
]

# Categorical columns whose nulls become "UNKNOWN".
CATEGORICAL_UNKNOWN_COLUMNS = {
    "borough", "complaint_type", "agency", "descriptor",
    "status", "city", "address_type", "agency_name",
}

# Upper-cased borough spelling -> standard borough name; anything else is UNKNOWN.
BOROUGH_MAP = {
    "BX": "BRONX", "BRONX": "BRONX",
    "BK": "BROOKLYN", "KINGS": "BROOKLYN", "BROOKLYN": "BROOKLYN",
    "MN": "MANHATTAN", "NEW YORK": "MANHATTAN", "MANHATTAN": "MANHATTAN",
    "QN": "QUEENS", "QUEENS": "QUEENS",
    "SI": "STATEN ISLAND", "RICHMOND": "STATEN ISLAND",
    "STATEN ISLAND": "STATEN ISLAND",
}

VALID_BOROUGHS = {"BRONX", "BROOKLYN", "MANHATTAN", "QUEENS", "STATEN ISLAND", "UNKNOWN"}

# Largest allowed null fraction per column (a rate strictly above fails).
NULL_THRESHOLDS = {
    "unique_key": 0.0,
    "created_date": 0.0,
    "complaint_type": 0.05,
    "agency": 0.05,
    "borough": 0.10,
}

# Coordinates outside these closed ranges are set to null.
LATITUDE_RANGE = (40.0, 41.0)
LONGITUDE_RANGE = (-75.0, -73.0)

# Page source limits and the minimum rows for a report to list a complaint type.
MAX_BATCH_SIZE = 1000
MIN_REQUESTS_FOR_SLOWEST = 100
TOP_COMPLAINT_TYPES = 20
TOP_AGENCIES = 15
TOP_SLOWEST = 20

# Star-schema table names.
STAR_TABLES = ["dim_agency", "dim_complaint", "dim_location", "dim_date", "fact_311_requests"]
FACT_TABLE = "fact_311_requests"
