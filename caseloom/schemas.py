"""Fixed schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


STR, INT, LONG = T.StringType(), T.IntegerType(), T.LongType()
SHORT, DOUBLE, BOOL = T.ShortType(), T.DoubleType(), T.BooleanType()
RATE = T.DecimalType(12, 4)
COORDINATE = T.DecimalType(9, 6)

# Raw observations are scanned as text; the cleaning operator does the casts.
RAW_COLUMNS = ["epi_week", "state", "loc", "loc_type", "disease", "cases", "incidence_per_100000"]
RAW = _struct(*[(name, STR) for name in RAW_COLUMNS])

OBSERVATIONS = _struct(
    ("epi_week", INT), ("state", STR), ("loc", STR), ("disease", STR),
    ("cases", INT), ("incidence_per_100000", DOUBLE), ("loc_type", STR),
)

REGIONS = _struct(
    ("state_code", STR), ("state_name", STR), ("census_region", STR),
    ("census_division", STR), ("latitude", DOUBLE), ("longitude", DOUBLE),
)
DISEASES = _struct(
    ("disease_name", STR), ("disease_category", STR), ("transmission_type", STR),
    ("is_vaccine_preventable", STR), ("vaccine_intro_year", INT),
)
POPULATIONS = _struct(("state_code", STR), ("decade", INT), ("population", INT), ("source", STR))
BORDER_LISTS = _struct(("state_code", STR), ("borders", STR))

DIM_TIME = _struct(
    ("time_key", INT), ("epi_week", INT), ("week_number", SHORT), ("month", SHORT),
    ("month_name", STR), ("quarter", SHORT), ("year", SHORT), ("decade", SHORT),
    ("century", SHORT), ("is_summer", BOOL), ("is_flu_season", BOOL),
)
DIM_LOCATION = _struct(
    ("location_key", INT), ("city_name", STR), ("state_code", STR), ("state_name", STR),
    ("census_region", STR), ("census_division", STR),
    ("latitude", COORDINATE), ("longitude", COORDINATE), ("loc_type", STR),
)
DIM_DISEASE = _struct(
    ("disease_key", INT), ("disease_name", STR), ("disease_category", STR),
    ("transmission_type", STR), ("is_vaccine_preventable", BOOL), ("vaccine_intro_year", SHORT),
)
# The last three are partition columns of the stored fact.
FACT = _struct(
    ("incidence_key", LONG), ("time_key", INT), ("location_key", INT),
    ("case_count", INT), ("incidence_rate", RATE), ("population", INT), ("year", INT),
    ("loc_type", STR), ("decade", INT), ("disease_key", INT),
)

WEEKLY = _struct(("epi_week", INT), ("week", INT), ("cases", INT), ("incidence_rate", DOUBLE))
_BUCKET_FIELDS = [
    ("disease", _struct(
        ("name", STR), ("category", STR), ("transmission", STR),
        ("vaccine_preventable", BOOL), ("vaccine_year", INT))),
    ("location", _struct(
        ("city", STR), ("state_code", STR), ("state_name", STR), ("region", STR),
        ("division", STR), ("loc_type", STR),
        ("coordinates", _struct(("lat", DOUBLE), ("lng", DOUBLE))))),
    ("time_bucket", _struct(
        ("year", INT), ("month", INT), ("month_name", STR), ("quarter", INT), ("decade", INT))),
    ("monthly_summary", _struct(
        ("total_cases", LONG), ("avg_incidence_rate", DOUBLE),
        ("peak_weekly_cases", INT), ("observation_count", LONG))),
]
BUCKETS = _struct(*_BUCKET_FIELDS, ("bucket_key", STR), ("decade", INT))
BUCKET_ROWS = _struct(
    ("bucket_key", STR), ("disease", STR), ("state_code", STR), ("year", INT), ("month", INT),
    ("epi_week", INT), ("week", INT), ("cases", INT), ("incidence_rate", DOUBLE), ("decade", INT))
# The nested view over both.
DOCUMENTS = _struct(
    *_BUCKET_FIELDS[:3], ("weekly_observations", T.ArrayType(WEEKLY, True)), _BUCKET_FIELDS[3])

OBSERVATION_NODES = _struct(
    ("observation_id", LONG), ("case_count", INT), ("incidence_rate", DOUBLE), ("grain", STR),
    ("disease", STR), ("state_code", STR), ("city_name", STR), ("epi_week", INT),
    ("year", INT), ("month", INT),
)
MONTHLY_AGGREGATES = _struct(
    ("disease", STR), ("state_code", STR), ("state_name", STR), ("year", INT), ("month", INT),
    ("month_name", STR), ("quarter", INT), ("total_cases", LONG), ("avg_incidence", DOUBLE),
    ("observation_count", LONG), ("decade", INT),
)
BORDERS = _struct(("src", STR), ("dst", STR))

EVENT = _struct(
    ("epi_week", INT), ("state", STR), ("loc", STR), ("loc_type", STR), ("disease", STR),
    ("cases", INT), ("incidence_rate", DOUBLE),
)
# One message of an event topic; the first three columns also exist on a Kafka source.
TOPIC = _struct(("key", STR), ("value", STR), ("timestamp", T.TimestampType()), ("event_id", LONG))
