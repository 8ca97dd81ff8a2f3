"""Nearest station for a table of points (J10 at scale) by an exact search down a tree of cells.

Stations with one coordinate are one place (smallest id). A cell that holds more
than ``LEAF_PLACES`` places is split into ``FAN x FAN`` parts of its own bounding
box, and so on, so depth follows the occupancy wherever the places lie: a part
always has places at both ends of the longer side, so every split tells some
apart, and no leaf holds more. The tree is a table of cells with their parents. All
points go down together: a point keeps, per level, the cells that can still
hold its nearest place, that is those whose bounding box begins no farther than
some kept box ends. A split cell's parts, and a leaf's places, are one row of
bounded width (``FAN * FAN``, ``LEAF_PLACES``), so a point meets them all in one row and only the
parts that it keeps are sorted by point. There is one round per level; nothing is
ever paired off as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from railyard.session import checkpoint_dir, write_table, write_table_metrics

_OUT = "{k} long, station_id long, station_name string, distance_score double"
# Parts of a split cell per axis, and places up to which a cell is not split.
FAN, LEAF_PLACES = 4, 8
ROOT = "0"
# Levels after which the points' kept cells are written, so that plans stay short.
PLAN_LEVELS = 2


def _square(x: Column) -> Column:
    return F.pow(x, F.lit(2))


def _nearest_of_box(box: Column) -> Column:
    gap = lambda p, lo, hi: F.greatest(box[lo] - F.col(p), F.col(p) - box[hi], F.lit(0.0))
    return _square(gap("latitude", "lat_lo", "lat_hi")) + _square(gap("longitude", "lon_lo", "lon_hi"))


def _farthest_of_box(box: Column) -> Column:
    reach = lambda p, lo, hi: F.greatest(F.abs(F.col(p) - box[lo]), F.abs(F.col(p) - box[hi]))
    return _square(reach("latitude", "lat_lo", "lat_hi")) + _square(reach("longitude", "lon_lo", "lon_hi"))


def cell_tree(places: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The cells of each level (``cell, parent, n, leaf`` and box) and the places with their leaf's ``cell``.

    ``places``: distinct ``latitude, longitude`` with what belongs to them. Only the places of cells that are split go on
    to the next level.
    """
    box = [F.count(F.lit(1)).alias("n"), F.min("latitude").alias("lat_lo"), F.max("latitude").alias("lat_hi"),
           F.min("longitude").alias("lon_lo"), F.max("longitude").alias("lon_hi")]
    now = write_table(places.withColumn("cell", F.lit(ROOT)).withColumn("parent", F.lit(None).cast("string")), "nearest-places")
    levels, leaves, splits = [], None, 1
    while splits:
        cells, seen = write_table_metrics(now.groupBy("cell", "parent").agg(*box).withColumn("leaf", F.col("n") <= LEAF_PLACES),
                                          "nearest-cells", splits=F.count_if(~F.col("leaf")))
        splits = seen["splits"]
        levels.append(cells)
        settled = now.join(cells.filter("leaf").select("cell"), "cell", "left_semi").drop("parent")
        leaves = settled if leaves is None else leaves.unionByName(settled)
        if splits:
            side = F.greatest(F.col("lat_hi") - F.col("lat_lo"), F.col("lon_hi") - F.col("lon_lo"))
            part = lambda axis, low: F.least(F.floor((F.col(axis) - F.col(low)) / side * FAN), F.lit(FAN - 1))
            of = (part("latitude", "lat_lo") * FAN + part("longitude", "lon_lo")).cast("string")
            now = write_table(now.drop("parent").join(cells.filter("NOT leaf").drop("parent", "n", "leaf"), "cell").select(
                *places.columns, F.concat_ws(".", "cell", of).alias("cell"), F.col("cell").alias("parent")), "nearest-places")
    return levels, leaves


def nearest_station_per_point(points: DataFrame, stations: DataFrame, point_key: str = "point_id") -> DataFrame:
    """``(point_key, station_id, station_name, distance_score)`` for every point with coordinates.

    Distance is the squared Euclidean distance on (latitude, longitude); ties
    go to the smaller station id. Rows with a null coordinate take no part.
    """
    spark = points.sparkSession
    checkpoint_dir(spark)
    located = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    places = stations.filter(located).groupBy("latitude", "longitude").agg(
        F.min(F.struct(F.col("station_id").cast("bigint").alias("id"), F.col("station_name").alias("name"))).alias("s"))
    levels, leaves = cell_tree(places)
    if levels[0].isEmpty():
        return spark.createDataFrame([], _OUT.format(k=point_key))
    point = [point_key, "latitude", "longitude"]
    box = F.struct("cell", "leaf", "lat_lo", "lat_hi", "lon_lo", "lon_hi")
    seen = lambda k: F.struct(k["cell"].alias("cell"), k["leaf"].alias("leaf"), _nearest_of_box(k).alias("near"), _farthest_of_box(k).alias("far"))
    top = levels[0].select(box.alias("box"))  # one row
    state = points.filter(located).select(*point).crossJoin(F.broadcast(top)) \
        .select(*point, seen(F.col("box")).alias("c")).select(*point, "c.*").withColumn("least", F.col("far"))
    mine = Window.partitionBy(*point)
    for k, level in enumerate(levels[1:], 1):
        # The parts of a cell meet a point as one row, and only those that it keeps become rows.
        parts = level.groupBy(F.col("parent").alias("cell")).agg(F.collect_list(box).alias("parts"))
        met = state.filter("NOT leaf").join(parts, "cell").select(*point, "least", F.transform("parts", seen).alias("parts"))
        met = met.withColumn("least", F.least("least", F.array_min("parts.far")))
        finer = met.select(*point, "least", F.explode(F.filter("parts", lambda c: c["near"] <= F.col("least"))).alias("c")).select(*point, "c.*", "least")
        both = state.filter("leaf").select(finer.columns).unionByName(finer)
        state = both.withColumn("least", F.min("least").over(mine)).filter("near <= least")
        state = write_table(state, "nearest-state") if k % PLAN_LEVELS == 0 else state
    dist = lambda x: _square(x["latitude"] - F.col("latitude")) + _square(x["longitude"] - F.col("longitude"))
    places = leaves.groupBy("cell").agg(F.collect_list(F.struct("latitude", "longitude", "s")).alias("places"))
    in_leaf = F.array_min(F.transform("places", lambda x: F.struct(dist(x).alias("d"), x["s"]["id"].alias("id"), x["s"]["name"].alias("name"))))
    best = state.select(*point, "cell").join(places, "cell").select(*point, in_leaf.alias("b")).groupBy(*point).agg(F.min("b").alias("b"))
    return best.select(point_key, F.col("b.id").alias("station_id"), F.col("b.name").alias("station_name"),
                       F.col("b.d").alias("distance_score"))
