"""Binding of the flows to a city incident table (22 text columns, one row per incident)."""

from __future__ import annotations

import datetime as dt

from sievework.operators.clean import Box
from sievework.plans.spec import CleaningSpec, FeatureSpec

# The columns of the raw table.
INCIDENT_COLUMNS = [
    "ID",
    "Case Number",
    "Date",
    "Block",
    "IUCR",
    "Primary Type",
    "Description",
    "Location Description",
    "Arrest",
    "Domestic",
    "Beat",
    "District",
    "Ward",
    "Community Area",
    "FBI Code",
    "X Coordinate",
    "Y Coordinate",
    "Year",
    "Updated On",
    "Latitude",
    "Longitude",
    "Location",
]

# Bounding box of the city in WGS84 degrees, first day, rare-class threshold.
CITY_BOX = Box(lat_min=41.60, lat_max=42.05, lon_min=-88.00, lon_max=-87.50)
FIRST_DAY = dt.date(2001, 1, 1)
RARE_THRESHOLD = 500

# Words that mark a busy place.
BUSY_PLACES = (
    "STREET",
    "SIDEWALK",
    "DEPARTMENT STORE",
    "RESTAURANT",
    "GROCERY STORE",
    "GAS STATION",
)

# Candidate features of the class model.
CANDIDATES = (
    "hour",
    "day_of_week",
    "month",
    "is_weekend",
    "is_night",
    "hour_sin",
    "hour_cos",
    "Latitude",
    "Longitude",
    "is_crowded",
    "community_area_enc",
)

# Column annotations as (name, declared type, nullable, zone, role).
_ANNOTATIONS = [
    ("ID", "int64", False, "both", "identifier"),
    ("Case Number", "string", False, "both", "identifier"),
    ("Date", "datetime64[ns]", False, "processed", "feature_source"),
    ("Block", "string", True, "both", "descriptive"),
    ("IUCR", "string", True, "both", "descriptive"),
    ("Primary Type", "string", False, "both", "target"),
    ("Description", "string", True, "both", "descriptive"),
    ("Location Description", "string", True, "both", "descriptive"),
    ("Arrest", "bool", False, "both", "excluded"),
    ("Domestic", "bool", False, "both", "feature_candidate"),
    ("Beat", "int64", False, "both", "feature_candidate"),
    ("District", "int64", False, "both", "feature_candidate"),
    ("Ward", "int64", False, "both", "feature_candidate"),
    ("Community Area", "int64", False, "both", "feature_candidate"),
    ("FBI Code", "string", True, "both", "descriptive"),
    ("X Coordinate", "float64", True, "both", "descriptive"),
    ("Y Coordinate", "float64", True, "both", "descriptive"),
    ("Year", "int64", False, "both", "feature_candidate"),
    ("Updated On", "datetime64[ns]", True, "both", "metadata"),
    ("Latitude", "float64", False, "both", "feature"),
    ("Longitude", "float64", False, "both", "feature"),
    ("Location", "string", True, "both", "descriptive"),
]
#: What a column holds, and what a reader should know of it.
_DESCRIPTIONS = {
    "ID": "Number of the record",
    "Case Number": "Number of the case; the first record of a case stays",
    "Date": "Local time at which the incident took place",
    "Block": "Address, shortened to the block",
    "IUCR": "Code of the offence in the state's uniform list",
    "Primary Type": "Class of the offence; rare ones are merged",
    "Description": "Kind of offence within its class",
    "Location Description": "Kind of place",
    "Arrest": "Whether an arrest followed; known only afterwards, so no feature",
    "Domestic": "Whether the incident was domestic",
    "Beat": "Smallest police area",
    "District": "Police district, made of beats",
    "Ward": "Ward of the city council; 0 if missing",
    "Community Area": "One of the city's community areas; 0 if missing",
    "FBI Code": "Code of the offence in the national list",
    "X Coordinate": "Easting in the state's plane grid, feet",
    "Y Coordinate": "Northing in the state's plane grid, feet",
    "Year": "Year of the incident",
    "Updated On": "When the record was last changed",
    "Latitude": "Degrees north",
    "Longitude": "Degrees east, negative",
    "Location": "Latitude and longitude as text",
}
INCIDENT_ANNOTATIONS = [(*row, None, _DESCRIPTIONS[row[0]]) for row in _ANNOTATIONS]


def incident_cleaning(as_of: dt.date) -> CleaningSpec:
    """Cleaning of the incident table as of a day.

    Arrival order within a case is the record number; rows without one come last.
    """
    return CleaningSpec(
        key=("Case Number",),
        order_by=("try_cast(ID AS bigint)", "ID"),
        critical=("Date", "Primary Type", "Latitude", "Longitude"),
        timestamp="Date",
        latitude="Latitude",
        longitude="Longitude",
        category="Primary Type",
        box=CITY_BOX,
        first_day=FIRST_DAY,
        as_of=as_of,
        rare_threshold=RARE_THRESHOLD,
        fill_unknown=("Description", "Location Description", "Block", "FBI Code", "IUCR"),
        long_keys=("ID",),
        longs=("Beat", "District", "Ward", "Community Area", "Year"),
        doubles=("Latitude", "Longitude", "X Coordinate", "Y Coordinate"),
        booleans=("Arrest", "Domestic"),
        texts=("Primary Type", "Description", "Location Description", "Block", "FBI Code", "IUCR"),
        other_timestamps=("Updated On",),
    )


def incident_features() -> FeatureSpec:
    """Features of the incident table."""
    return FeatureSpec(
        timestamp="Date",
        category="Primary Type",
        area="Community Area",
        place="Location Description",
        place_keywords=BUSY_PLACES,
        key="ID",
        candidates=CANDIDATES,
        label="crime_type_label",
        area_code="community_area_enc",
    )
