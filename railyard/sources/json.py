"""Station metadata JSON.

The document shape is ``{"result": [station, ...]}``; a station holds
``evaNumbers`` of which the ``isMain`` entry supplies id and ``[lon, lat]``
coordinates. Parsing uses a declared schema (no inference) and only built-in
array/struct functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from railyard.functions.movement import text_to_bool
from railyard.schemas import STATION_DOCUMENT, STATION_JSON


def read_station_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole-document files (``{"result": [...]}``, possibly pretty-printed): one row per station."""
    docs = spark.read.option("multiLine", True).schema(STATION_DOCUMENT).json(path)
    return docs.select(F.explode("result").alias("st"))


def read_station_lines(spark: SparkSession, path: str) -> DataFrame:
    """JSON Lines of station objects (splittable; the layout to use for large inputs)."""
    return spark.read.schema(STATION_JSON).json(path).select(F.struct("*").alias("st"))


def parse_station_documents(docs: DataFrame, text_col: str = "value") -> DataFrame:
    """Document text column -> one row per station (``st`` struct); malformed text gives none."""
    parsed = docs.select(F.from_json(F.col(text_col), STATION_DOCUMENT).alias("d"))
    return parsed.select(F.explode("d.result").alias("st"))


def flatten_stations(stations: DataFrame) -> DataFrame:
    """Flatten ``st`` into the station dimension's columns.

    The first main EVA entry gives the id and coordinates; stations without a
    main entry, or whose number is missing or 0, are dropped. Coordinates are
    ``[lon, lat]``; a short array gives null (not an error).
    """
    main = F.get(F.filter("st.evaNumbers", lambda e: F.coalesce(e["isMain"], F.lit(False))), 0)
    with_main = stations.select("st", main.alias("main")).filter(
        F.col("main").isNotNull() & (F.coalesce(F.col("main.number"), F.lit(0)) != 0))
    coords = F.col("main.geographicCoordinates.coordinates")
    return with_main.select(
        F.col("main.number").alias("station_id"),
        F.col("st.name").alias("station_name"),
        F.get(coords, 1).alias("latitude"),
        F.get(coords, 0).alias("longitude"),
        F.col("st.ifopt").alias("ifopt_id"),
        F.col("st.category").alias("category"),
        F.col("st.priceCategory").alias("price_category"),
        F.col("st.mailingAddress.zipcode").alias("zipcode"),
        F.col("st.hasSteplessAccess").alias("has_stepless_access"),
        text_to_bool(F.col("st.hasWiFi")).alias("has_wifi"))
