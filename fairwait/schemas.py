"""Declared schemas and the fixed values of the data contract."""

from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STRING, BOOLEAN, DOUBLE, INT = StringType(), BooleanType(), DoubleType(), IntegerType()
WALL_CLOCK, DATE = TimestampNTZType(), DateType()


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


# One raw record as landed: text except for two booleans.
BRONZE = _struct(
    sr_number=STRING,
    sr_type=STRING,
    sr_short_code=STRING,
    owner_department=STRING,
    status=STRING,
    origin=STRING,
    created_date=STRING,
    last_modified_date=STRING,
    closed_date=STRING,
    community_area=STRING,
    ward=STRING,
    zip_code=STRING,
    duplicate=BOOLEAN,
    legacy_record=BOOLEAN,
    latitude=STRING,
    longitude=STRING,
)

# One cleaned request; timestamps are local wall-clock time.
SILVER = _struct(
    sr_number=STRING,
    sr_type=STRING,
    sr_short_code=STRING,
    owner_department=STRING,
    status=STRING,
    origin=STRING,
    created_ts=WALL_CLOCK,
    closed_ts=WALL_CLOCK,
    last_modified_ts=WALL_CLOCK,
    resolution_hours=DOUBLE,
    is_closed=BOOLEAN,
    has_valid_resolution=BOOLEAN,
    community_area=INT,
    ward=INT,
    zip_code=STRING,
    latitude=DOUBLE,
    longitude=DOUBLE,
    has_valid_geo=BOOLEAN,
    city_flagged_duplicate=BOOLEAN,
    legacy_record=BOOLEAN,
    created_date_only=DATE,
    created_year=INT,
    created_month=INT,
)

# The census seed is quoted text throughout; staging types it.
CENSUS = _struct(
    community_area_number=STRING,
    community_area_name=STRING,
    pct_housing_crowded=STRING,
    pct_below_poverty=STRING,
    pct_unemployed=STRING,
    pct_no_hs_diploma=STRING,
    pct_under18_over64=STRING,
    per_capita_income=STRING,
    hardship_index=STRING,
)

# Results depend on them.
TIME_ZONE = "America/Chicago"
LATITUDE_BOUNDS = (41.60, 42.10)
LONGITUDE_BOUNDS = (-87.95, -87.50)
AREA_BOUNDS = (1, 77)
NOT_A_SERVICE = ("%information only%", "%aircraft noise%")
HIGH_VOLUME = 1000
QUARTILES = 4
SILVER_PARTITIONS = ("created_year", "created_month")
