"""Nearest stations on the sphere, by cubes of growing size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise, remove, stored

EARTH_KM = 6371.0
NEIGHBOURS = 5
WITHIN_KM = 500.0
# the smallest cubes are this part of the distance limit; every next size is GROWTH times larger
FINEST = 64
GROWTH = 4


def sphere_point(lat: Column, lon: Column) -> list[Column]:
    """x, y, z in km from the centre of the earth.

    Cubes of such points have no borders at the poles or the date line, and a chord
    is never longer than the way on the ground, so what is near is in near cubes.
    """
    north, east = F.radians(lat.cast("double")), F.radians(lon.cast("double"))
    return [
        (EARTH_KM * F.cos(north) * F.cos(east)).alias("x"),
        (EARTH_KM * F.cos(north) * F.sin(east)).alias("y"),
        (EARTH_KM * F.sin(north)).alias("z"),
    ]


def ground_km(chord: Column) -> Column:
    """Length on the ground of a straight line between two points."""
    return 2 * EARTH_KM * F.asin(F.least(chord / (2 * EARTH_KM), F.lit(1.0)))


def nearest_stations(
    stations: DataFrame, count: int = NEIGHBOURS, within_km: float = WITHIN_KM
) -> DataFrame:
    """(id, rank, neighbour, distance_km): the ``count`` nearest other stations.

    ``stations`` has one row per id with ``lat`` and ``lon``; those without both have
    no neighbours and are none. Equal distances go to the smaller id. Stations are
    looked up in cubes of a few sizes: a station that has found enough others nearer
    than the width of a cube is done, and only the others look in larger cubes, where
    there are few around them. No station is compared with all others. Of stations at
    one place the first ``count`` + 1 stand for all, since nobody needs more.
    """
    spark = stations.sparkSession
    placed = stations.dropna(subset=["id", "lat", "lon"]).select("id", "lat", "lon", *sphere_point(F.col("lat"), F.col("lon")))
    placed, path = stored(placed, "stations")
    paths, found = [path], []
    at_place = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("id"))
    others = placed.withColumn("place", at_place).filter(F.col("place") <= count + 1).drop("place")
    others = others.select(F.col("id").alias("neighbour"), *(F.col(c).alias(f"{c}2") for c in "xyz"))
    waiting, width = placed, within_km / FINEST
    while True:
        last = width >= within_km
        ranked = _within_cubes(waiting, others, width if not last else within_km, count)
        ranked, path = stored(ranked, "nearest")
        paths.append(path)
        if last:
            found.append(ranked)
            break
        done = ranked.filter((F.col("rank") == count) & (F.col("chord") <= width)).select("id")
        found.append(ranked.join(done, "id", "left_semi"))
        waiting = waiting.join(done, "id", "left_anti")
        width = min(width * GROWTH, within_km)
    rows = found[0]
    for more in found[1:]:
        rows = rows.unionByName(more)
    distance = ground_km(F.col("chord")).alias("distance_km")
    result = rows.select("id", "rank", "neighbour", distance).filter(F.col("distance_km") <= within_km)
    try:
        return materialise(result, "neighbours")
    finally:
        for path in paths:
            remove(spark, path)


def _within_cubes(waiting: DataFrame, others: DataFrame, width: float, count: int) -> DataFrame:
    """The nearest of the stations in the cube of each station and the 26 around it."""

    def cube(suffix: str, *step: Column) -> list[Column]:
        steps = step or (F.lit(0),) * 3
        return [
            (F.floor(F.col(f"{axis}{suffix}") / width) + by).cast("int").alias(f"cube_{axis}")
            for axis, by in zip("xyz", steps, strict=True)
        ]

    around = F.explode(F.sequence(F.lit(0), F.lit(26))).alias("around")
    steps = [F.floor(F.col("around") / 3**k) % 3 - 1 for k in range(3)]
    asking = waiting.select("id", "x", "y", "z", around).select("id", "x", "y", "z", *cube("", *steps))
    pairs = asking.join(others.select("*", *cube("2")), ["cube_x", "cube_y", "cube_z"])
    chord = F.sqrt(sum((F.col(f"{axis}2") - F.col(axis)) ** 2 for axis in "xyz"))
    pairs = pairs.filter(F.col("id") != F.col("neighbour")).select("id", "neighbour", chord.alias("chord"))
    order = Window.partitionBy("id").orderBy("chord", "neighbour")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= count)
