"""Stations in many boxes and polygons at once.

The plane is cut into cells. A region names the cells that it touches, a station its own, and both meet in an equi-join.
Cells that lie wholly inside a region need no more; in cells on its border the polygon decides, by counting the
edges that a ray crosses.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hydroflow.operators.positions import null_safe_join

#: Width and height of a cell, in degrees.
CELL = 0.25


def box_ring(lon_min: Column, lat_min: Column, lon_max: Column, lat_max: Column) -> Column:
    """The corners of a box as a ring."""
    corners = [(lon_min, lat_min), (lon_max, lat_min), (lon_max, lat_max), (lon_min, lat_max)]
    return F.array(*[F.struct(x.cast("double").alias("lon"), y.cast("double").alias("lat")) for x, y in corners])


def _edges(ring: Column) -> Column:
    """The ring's edges; the last corner is joined to the first."""
    after = F.concat(F.slice(ring, F.lit(2), F.size(ring) - 1), F.slice(ring, 1, 1))
    return F.zip_with(ring, after, lambda a, b: F.struct(a["lon"].alias("x0"), a["lat"].alias("y0"), b["lon"].alias("x1"), b["lat"].alias("y1")))


def _crosses(e: Column, x: Column, y: Column) -> Column:
    """A ray from the point to larger longitudes crosses the edge."""
    above = (e["y0"] > y) != (e["y1"] > y)
    at = e["x0"] + F.try_divide((y - e["y0"]) * (e["x1"] - e["x0"]), e["y1"] - e["y0"])
    return above & (x < at)


def _on_edge(e: Column, x: Column, y: Column) -> Column:
    cross = (x - e["x0"]) * (e["y1"] - e["y0"]) - (y - e["y0"]) * (e["x1"] - e["x0"])
    between = x.between(F.least(e["x0"], e["x1"]), F.greatest(e["x0"], e["x1"])) & y.between(F.least(e["y0"], e["y1"]), F.greatest(e["y0"], e["y1"]))
    return (cross == 0) & between


def inside(edges: Column, x: Column, y: Column) -> Column:
    """The point lies inside the ring, not on its border."""
    crossings = F.size(F.filter(edges, lambda e: _crosses(e, x, y)))
    return (crossings % 2 == 1) & ~F.exists(edges, lambda e: _on_edge(e, x, y))


def region_cells(regions: DataFrame, cell: float = CELL) -> DataFrame:
    """``(region_id, cx, cy, border, edges)``: the cells of every region. Those that no edge comes near are either wholly
    inside, with ``border`` false and no edges, or left out."""
    lons, lats = F.transform("ring", lambda p: p["lon"]), F.transform("ring", lambda p: p["lat"])

    def span(values: Column) -> Column:
        return F.sequence(F.floor(F.array_min(values) / cell), F.floor(F.array_max(values) / cell))

    known = regions.filter(F.size("ring") >= 3).select("region_id", _edges(F.col("ring")).alias("edges"), span(lons).alias("xs"), span(lats).alias("ys"))
    cells = known.withColumn("cx", F.explode("xs")).withColumn("cy", F.explode("ys"))
    left, low = F.col("cx") * cell, F.col("cy") * cell

    def near(e: Column) -> Column:
        across = (F.least(e["x0"], e["x1"]) <= left + cell) & (F.greatest(e["x0"], e["x1"]) >= left)
        return across & (F.least(e["y0"], e["y1"]) <= low + cell) & (F.greatest(e["y0"], e["y1"]) >= low)

    cells = cells.withColumn("border", F.exists("edges", near))
    middle = inside(F.col("edges"), left + cell / 2, low + cell / 2)
    return cells.filter(F.col("border") | middle).select(
        "region_id", "cx", "cy", "border", F.when(F.col("border"), F.col("edges")).alias("edges")
    )


def stations_in_regions(things: DataFrame, locations: DataFrame, regions: DataFrame, cell: float = CELL) -> DataFrame:
    """``(region_id, iot_id, name)`` of every station with a location inside a region (borders excluded), each once.

    ``regions`` has ``region_id`` and ``ring``, its corners in order as an array of (lon, lat); rings of fewer than three
    corners or with NULLs hold nothing. Locations without coordinates are nowhere. A region costs a row per cell of its
    bounding box: choose ``cell`` by the size of the regions.
    """
    whole = regions.filter(~F.exists("ring", lambda p: p["lon"].isNull() | p["lat"].isNull()))
    lon, lat = F.get("coordinates", F.lit(0)), F.get("coordinates", F.lit(1))
    placed = locations.select("thing_id", lon.alias("lon"), lat.alias("lat")).filter("lon is not null and lat is not null")
    placed = placed.withColumn("cx", F.floor(F.col("lon") / cell)).withColumn("cy", F.floor(F.col("lat") / cell))
    met = placed.join(region_cells(whole, cell), ["cx", "cy"])
    within = met.filter(~F.col("border") | inside(F.col("edges"), F.col("lon"), F.col("lat")))
    found = within.select("region_id", F.col("thing_id").alias("iot_id")).distinct()
    return null_safe_join(things.select("iot_id", "name"), found, ["iot_id"]).select("region_id", "iot_id", "name")
