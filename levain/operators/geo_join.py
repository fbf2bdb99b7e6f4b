"""Point pairs within a radius, as an equi-join on grid cells (no cross join).

The reference's distance fact pairs every franchise with every supplier; its output is
quadratic by definition.  Here the pair table is re-aimed as "pairs within ``max_km``":
points are placed in latitude bands of height >= the radius and, inside a band, in
longitude cells at least as wide as the largest longitude span a circle of that radius
can have at the band's highest latitude (one cell for polar bands).  The probe side
keeps one (band, cell) key, the build side is emitted to the neighbouring bands and
cells (at most 9 keys), every candidate pair meets in exactly one key, and the exact
haversine filter keeps the true pairs.  Work grows with the number of close pairs, not
with |left| x |right|; AQE splits a dense cell if one join partition is skewed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levain.functions.geo import EARTH_RADIUS_KM, haversine_km

_MARGIN = 1.0 + 1e-6


def _band_height_deg(max_km: float) -> float:
    return math.degrees(max_km / EARTH_RADIUS_KM) * _MARGIN + 1e-9


def _cells_expr(band, height: float, max_km: float):
    """Number of longitude cells in a band (SQL expression on the band number)."""
    theta = min(max_km / EARTH_RADIUS_KM, math.pi / 2)  # a circle beyond a quarter turn holds a pole: one cell
    lo = F.lit(-90.0) + band * F.lit(height)
    hi = F.least(F.lit(90.0), lo + F.lit(height))
    phi_max = F.greatest(F.abs(lo), F.abs(hi))
    cos_max = F.cos(F.radians(phi_max))
    span = F.degrees(F.asin(F.least(F.lit(1.0), F.lit(math.sin(theta)) / cos_max))) * F.lit(_MARGIN)
    n = F.floor(F.lit(360.0) / span)
    return F.when(cos_max <= F.lit(math.sin(theta)) * F.lit(_MARGIN), F.lit(1)).when(n < 3, F.lit(1)) \
        .otherwise(n).cast("int")


def _band(lat, height: float):
    return F.floor((lat + F.lit(90.0)) / F.lit(height)).cast("int")


def _cell(lon, ncells):
    width = F.lit(360.0) / ncells
    return F.pmod(F.floor((lon + F.lit(180.0)) / width).cast("int"), ncells)


def pairs_within(left: DataFrame, right: DataFrame, max_km: float,
                 left_coords=("latitude", "longitude"), right_coords=("latitude", "longitude"),
                 distance_col: str = "distance_km") -> DataFrame:
    """All (left, right) rows whose points are at most ``max_km`` apart, with the distance.

    Coordinates must be non-NULL degrees in [-90, 90] x [-180, 180]; filter before.
    Column names of the two sides must not clash (alias them first).
    """
    if max_km <= 0:
        raise ValueError("max_km must be positive")
    h = _band_height_deg(max_km)
    llat, llon = (F.col(c) for c in left_coords)
    rlat, rlon = (F.col(c) for c in right_coords)

    lb = _band(llat, h)
    probe = left.withColumn("__band", lb)
    probe = probe.withColumn("__cell", _cell(llon, _cells_expr(F.col("__band"), h, max_km)))

    # build side: neighbouring bands, and in each its own cell and the two adjacent ones
    build = right.withColumn("__rb", _band(rlat, h))
    build = build.withColumn("__band", F.explode(F.array(F.col("__rb") - 1, F.col("__rb"), F.col("__rb") + 1)))
    build = build.withColumn("__nc", _cells_expr(F.col("__band"), h, max_km))
    c0 = _cell(rlon, F.col("__nc"))
    build = build.withColumn("__cell", F.explode(F.array_distinct(F.array(
        F.pmod(c0 - 1, F.col("__nc")), c0, F.pmod(c0 + 1, F.col("__nc"))))))
    build = build.drop("__rb", "__nc")

    j = probe.join(build, ["__band", "__cell"], "inner").drop("__band", "__cell")
    d = haversine_km(llat, llon, rlat, rlon)
    return j.withColumn(distance_col, d).filter(F.col(distance_col) <= F.lit(float(max_km)))


#: Levels of the cell hierarchy: level l parts the cube around the unit sphere into cells of side 2 / 2**l (level 22: 3 m).
LEVELS = 22


def _unit(lat: str, lon: str) -> dict[str, Column]:
    """The point on the unit sphere: no poles, no date line; straight distances rise with great-circle ones."""
    phi, lam = F.radians(F.col(lat)), F.radians(F.col(lon))
    return {"__x": F.cos(phi) * F.cos(lam), "__y": F.cos(phi) * F.sin(lam), "__z": F.sin(phi)}


def _cell_at(level: Column) -> Column:
    """The cell (three numbers) of a point's unit vector at a level."""
    n = F.pow(F.lit(2.0), level)
    return F.array(*(F.least(F.floor((F.col(c) + 1) / 2 * n), n - 1).cast("long") for c in ("__x", "__y", "__z")))


def _levels(points: DataFrame) -> DataFrame:
    """Each point once for each level, with its cell there."""
    return points.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS)))).withColumn("__cell", _cell_at(F.col("__level")))


def nearest(left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str,
            left_coords=("latitude", "longitude"), right_coords=("latitude", "longitude"),
            distance_col: str = "distance_km") -> DataFrame:
    """(left_id, rank, right_id, distance): the ``k`` nearest right rows of each left row (all, if fewer), ties to the
    smaller ``right_id``.  Coordinates as in ``pairs_within``; ids are unique.

    One lazy plan over a hierarchy of cells whose counts of right points tell the density.  Each distinct left point starts at its
    smallest cell with ``k`` right points; the k-th nearest there bounds the search, which then reads the cells
    around the point at the level whose side is just not below that bound.  So work follows the points near
    by, in a crowded city and on an empty ocean alike.  Of right rows at one point only the ``k`` with the smallest
    ids can be among the results, so a crowded point costs k rows.  Output is ``k`` rows for each left row.
    """
    here = left.select(left_id, F.col(left_coords[0]).alias("__plat"), F.col(left_coords[1]).alias("__plon"))
    there = right.select(F.col(right_id).alias("__rid"), F.col(right_coords[0]).alias("__rlat"), F.col(right_coords[1]).alias("__rlon"))
    at_point = Window.partitionBy("__rlat", "__rlon").orderBy("__rid")
    there = there.withColumn("__n", F.row_number().over(at_point)).filter(F.col("__n") <= k).drop("__n")
    there = _levels(there.withColumns(_unit("__rlat", "__rlon"))).select("__level", "__cell", "__rid", "__rlat", "__rlon", F.struct("__x", "__y", "__z").alias("__r"))
    points = here.select("__plat", "__plon").distinct().withColumns(_unit("__plat", "__plon"))

    # the smallest cell around each left point that holds k right points (the whole cube, if none does)
    full = there.groupBy("__level", "__cell").agg(F.count("*").alias("__n")).filter((F.col("__n") >= k) | (F.col("__level") == 0)).select("__level", "__cell")
    start = _levels(points).join(full, ["__level", "__cell"]).groupBy("__plat", "__plon").agg(F.max("__level").alias("__level"))
    start = start.withColumns(_unit("__plat", "__plon")).withColumn("__cell", _cell_at(F.col("__level")))

    # the k-th nearest in it bounds the search (no bound where there are fewer than k)
    apart = F.sqrt(sum((F.col(f"__r.{c}") - F.col(c)) ** 2 for c in ("__x", "__y", "__z")))
    by_point = Window.partitionBy("__plat", "__plon")
    first = start.join(there.select("__level", "__cell", "__r"), ["__level", "__cell"]).select("__plat", "__plon", apart.alias("__d"))
    first = first.withColumn("__n", F.row_number().over(by_point.orderBy("__d"))).filter(F.col("__n") <= k)
    bound = first.groupBy("__plat", "__plon").agg(F.max("__d").alias("__d"), F.count("*").alias("__n"))
    reach = F.when(F.col("__n") < k, 2.0).otherwise(F.col("__d") * _MARGIN + 1e-9)
    level = F.greatest(F.lit(0), F.least(F.lit(LEVELS), F.floor(F.log2(F.lit(2.0) / reach)))).cast("int")
    around = bound.withColumn("__level", level).withColumns(_unit("__plat", "__plon")).withColumn("__own", _cell_at(F.col("__level")))
    step = F.sequence(F.lit(-1), F.lit(1))
    ring = F.flatten(F.transform(step, lambda x: F.flatten(F.transform(step, lambda y: F.transform(step, lambda z: F.array(
        F.get("__own", F.lit(0)) + x, F.get("__own", F.lit(1)) + y, F.get("__own", F.lit(2)) + z))))))
    around = around.select("__plat", "__plon", "__level", F.explode(ring).alias("__cell"))
    hits = around.join(there.select("__level", "__cell", "__rid", "__rlat", "__rlon"), ["__level", "__cell"])
    hits = hits.select("__plat", "__plon", "__rid", haversine_km(F.col("__plat"), F.col("__plon"), F.col("__rlat"), F.col("__rlon")).alias("__km"))
    hits = hits.withColumn("rank", F.row_number().over(by_point.orderBy("__km", "__rid"))).filter(F.col("rank") <= k)
    return here.join(hits, ["__plat", "__plon"]).select(left_id, "rank", F.col("__rid").alias(right_id), F.col("__km").alias(distance_col))
