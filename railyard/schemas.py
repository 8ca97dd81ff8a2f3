"""Declared schemas of the star schema, the movement Parquet and the raw documents."""

from pyspark.sql import types as T

# FIXED VALUES: column names, types and keys of the published tables.
DIM_STATION = T.StructType([
    T.StructField("station_id", T.LongType(), False),
    T.StructField("station_name", T.StringType(), False),
    T.StructField("latitude", T.DecimalType(9, 6), True),
    T.StructField("longitude", T.DecimalType(9, 6), True),
    T.StructField("ifopt_id", T.StringType(), True),
    T.StructField("category", T.IntegerType(), True),
    T.StructField("price_category", T.IntegerType(), True),
    T.StructField("zipcode", T.StringType(), True),
    T.StructField("has_stepless_access", T.StringType(), True),
    T.StructField("has_wifi", T.BooleanType(), True),
])

DIM_TIME = T.StructType([
    T.StructField("time_id", T.IntegerType(), False),
    T.StructField("slot_ts", T.TimestampNTZType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("year", T.IntegerType(), False),
    T.StructField("month", T.IntegerType(), False),
    T.StructField("day", T.IntegerType(), False),
    T.StructField("day_of_week", T.StringType(), False),
    T.StructField("hour", T.IntegerType(), False),
    T.StructField("minute", T.IntegerType(), False),
    T.StructField("is_peak_hour", T.BooleanType(), False),
    T.StructField("is_weekend", T.BooleanType(), False),
])

DIM_TRAIN = T.StructType([
    T.StructField("train_id", T.StringType(), False),
    T.StructField("line_category", T.StringType(), False),
    T.StructField("train_number", T.IntegerType(), True),
    T.StructField("owner_id", T.StringType(), True),
])

FACT_MOVEMENT = T.StructType([
    T.StructField("station_id", T.LongType(), False),
    T.StructField("time_id", T.IntegerType(), False),
    T.StructField("train_id", T.StringType(), False),
    T.StructField("stop_id", T.StringType(), False),
    T.StructField("is_arrival", T.BooleanType(), False),
    T.StructField("planned_platform", T.StringType(), True),
    T.StructField("actual_platform", T.StringType(), True),
    T.StructField("planned_time", T.TimestampNTZType(), True),
    T.StructField("actual_time", T.TimestampNTZType(), True),
    T.StructField("delay_minutes", T.IntegerType(), True),
    T.StructField("is_canceled", T.BooleanType(), True),
])

# Parquet layout of the Spark path, partitioned by event_date.
MOVEMENT_EVENT = T.StructType([
    T.StructField("station_name", T.StringType(), True),
    T.StructField("stop_id", T.StringType(), True),
    T.StructField("train_id", T.StringType(), True),
    T.StructField("is_arrival", T.BooleanType(), True),
    T.StructField("planned_time", T.TimestampNTZType(), True),
    T.StructField("actual_time", T.TimestampNTZType(), True),
    T.StructField("delay_minutes", T.DoubleType(), True),
    T.StructField("is_canceled", T.BooleanType(), True),
    T.StructField("event_date", T.DateType(), True),
])

# Unique key of the warehouse fact.
FACT_UNIQUE_KEY = ("station_id", "time_id", "stop_id", "is_arrival")
FACT_NOT_NULL = ("station_id", "time_id", "train_id", "stop_id", "is_arrival")

# One attribute-only timetable element (<ar>/<dp>); all attributes optional text.
_STOP_EVENT = T.StructType([
    T.StructField("_pt", T.StringType(), True),
    T.StructField("_pp", T.StringType(), True),
    T.StructField("_ct", T.StringType(), True),
    T.StructField("_cp", T.StringType(), True),
    T.StructField("_cs", T.StringType(), True),
    T.StructField("_clt", T.StringType(), True),
])

TIMETABLE_XML = T.StructType([
    T.StructField("_station", T.StringType(), True),
    T.StructField("s", T.ArrayType(T.StructType([
        T.StructField("_id", T.StringType(), True),
        T.StructField("tl", T.StructType([
            T.StructField("_c", T.StringType(), True),
            T.StructField("_n", T.StringType(), True),
            T.StructField("_o", T.StringType(), True),
        ]), True),
        T.StructField("ar", _STOP_EVENT, True),
        T.StructField("dp", _STOP_EVENT, True),
    ])), True),
    T.StructField("_corrupt_record", T.StringType(), True),
])

# Station metadata document: {"result": [station, ...]}. hasWiFi may be a JSON
# boolean or text; reading it as text keeps both ("true"/"True"/"false").
STATION_JSON = T.StructType([
    T.StructField("name", T.StringType(), True),
    T.StructField("ifopt", T.StringType(), True),
    T.StructField("category", T.IntegerType(), True),
    T.StructField("priceCategory", T.IntegerType(), True),
    T.StructField("hasSteplessAccess", T.StringType(), True),
    T.StructField("hasWiFi", T.StringType(), True),
    T.StructField("mailingAddress", T.StructType([
        T.StructField("zipcode", T.StringType(), True),
    ]), True),
    T.StructField("evaNumbers", T.ArrayType(T.StructType([
        T.StructField("number", T.LongType(), True),
        T.StructField("isMain", T.BooleanType(), True),
        T.StructField("geographicCoordinates", T.StructType([
            T.StructField("coordinates", T.ArrayType(T.DoubleType()), True),
        ]), True),
    ])), True),
])

STATION_DOCUMENT = T.StructType([
    T.StructField("result", T.ArrayType(STATION_JSON), True),
])
