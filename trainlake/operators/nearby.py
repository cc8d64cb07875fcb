"""Counts and nearest neighbours on the sphere without forming every pair.

The points are summed up in boxes: the cells of a grid that fits the radius are cut into
``PARTS`` × ``PARTS`` boxes, and each of these again.  A box knows how many points it has and a circle that
holds them all, so the distance from a place to any of its points lies between two bounds.
Places meet the larger boxes around them first, then the smaller boxes of those that the
bounds leave open, and single points only in the smaller boxes that are still open.

What a place meets is bounded by the number of boxes around it, however many points are in
them; all joins are equi-joins on boxes, whose crowded keys adaptive execution splits.
"""

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.functions.geo import EARTH_RADIUS_KM, haversine_km
from trainlake.operators.filters import all_of
from trainlake.operators.spatial import Grid
from trainlake.shared import cut

PARTS = 8
#: More than rounding can do to a distance.
_SLACK_KM = 1e-6
HALF_ROUND_KM = math.pi * EARTH_RADIUS_KM
_LARGE, _SMALL = ("_band", "_cell", "_i", "_j"), ("_band", "_cell", "_i", "_j", "_si", "_sj")


def _boxed(points: DataFrame, grid: Grid) -> DataFrame:
    """Points (``_lat``, ``_lon`` in −180 … 180) with the boxes they are in: cell, larger box, smaller box."""
    turn = "((_lon + 180D) / 360D * _cells)"
    fine = PARTS * PARTS
    return (
        points.withColumn("_band", F.expr(grid.band("_lat")))
        .withColumn("_cells", F.expr(grid.cells("_band")))
        .withColumn("_cell", F.expr(grid.cell("_lon", "_cells")))
        .withColumn("_y", F.expr(f"least(greatest(floor((_lat / {grid.height!r}D - _band) * {fine}), 0L), {fine - 1}L)"))
        .withColumn("_x", F.expr(f"least(greatest(floor(({turn} - floor({turn})) * {fine}), 0L), {fine - 1}L)"))
        .withColumns({"_i": F.expr(f"_y div {PARTS}"), "_j": F.expr(f"_x div {PARTS}"), "_si": F.expr(f"_y % {PARTS}"), "_sj": F.expr(f"_x % {PARTS}")})
        .drop("_cells", "_x", "_y")
    )


def _boxes(points: DataFrame, key: Sequence[str]) -> DataFrame:
    """Per box its points' number and extent; from points or from smaller boxes."""
    if "_n" not in points.columns:
        points = points.withColumn("_n", F.lit(1).cast("long"))
    if "_south" not in points.columns:
        points = points.withColumns({"_south": F.col("_lat"), "_north": F.col("_lat"), "_west": F.col("_lon"), "_east": F.col("_lon")})
    return points.groupBy(*key).agg(
        F.sum("_n").alias("_n"), F.min("_south").alias("_south"), F.max("_north").alias("_north"),
        F.min("_west").alias("_west"), F.max("_east").alias("_east"),
    )


def _bounds(pairs: DataFrame) -> DataFrame:
    """``_lo`` and ``_hi``: bounds of the distance from (``_at_lat``, ``_at_lon``) to any point of the box.

    The circle around the middle of the box reaches its points by a way along the meridian and
    then along the box's longest parallel.
    """
    middle = haversine_km(F.col("_at_lat"), F.col("_at_lon"), F.expr("(_south + _north) / 2"), F.expr("(_west + _east) / 2"))
    widest = F.expr("CASE WHEN _south <= 0D AND _north >= 0D THEN 1D ELSE cos(radians(least(abs(_south), abs(_north)))) END")
    reach = (F.radians(F.col("_north") - F.col("_south")) + F.radians(F.col("_east") - F.col("_west")) * widest) / 2 * EARTH_RADIUS_KM
    slack = F.when(reach > 0, reach + _SLACK_KM).otherwise(F.lit(_SLACK_KM))
    pairs = pairs.withColumns({"_middle": middle, "_reach": slack})
    return pairs.withColumns({"_lo": F.col("_middle") - F.col("_reach"), "_hi": F.col("_middle") + F.col("_reach")}).drop("_middle", "_reach", "_south", "_north", "_west", "_east")


class _Meeting:
    """Places of the left side with the boxes and points of the right side around them."""

    def __init__(self, left: DataFrame, right: DataFrame, radius_km: float, key: Sequence[str], left_at, right_at):
        self.radius, self.grid = radius_km, Grid(radius_km)
        self.key = list(key)
        self.places = left.dropna(subset=list(left_at)).select(*self.key, F.col(left_at[0]).alias("_at_lat"), F.col(left_at[1]).alias("_at_lon"))
        lon = F.col(right_at[1])
        known = right.dropna(subset=list(right_at)).withColumns({"_lat": F.col(right_at[0]).cast("double"), "_lon": F.when(lon >= 180, lon - 360).otherwise(lon).cast("double")})
        self.points = _boxed(known, self.grid)
        self.small = _boxes(self.points, _SMALL)
        self.large = _boxes(self.small, _LARGE)
        self.around = [*self.key, "_at_lat", "_at_lon"]

    def large_boxes(self) -> DataFrame:
        """Places with all larger boxes that may hold points within the radius, and the bounds."""
        grid = self.grid
        at = (
            self.places.withColumn("_band2", F.expr(grid.band("_at_lat")))
            .withColumn("_cells", F.expr(grid.cells("_band2")))
            .withColumn("_cell2", F.expr(grid.cell("_at_lon", "_cells")))
            .drop("_cells")
        )
        # a box may lie over a border between the cells of the band next to its own
        cells = "transform(sequence(_first - 1L, _last + 1L), c -> pmod(c, _cells))"
        near = (
            self.large.withColumn("_band2", F.expr("explode(array(_band - 1L, _band, _band + 1L))"))
            .withColumn("_cells", F.expr(grid.cells("_band2")))
            .withColumns({"_first": F.expr("floor((_west + 180D) / 360D * _cells)"), "_last": F.expr("floor((_east + 180D) / 360D * _cells)")})
            .withColumn("_cell2", F.expr(f"explode(array_distinct({cells}))"))
            .drop("_cells", "_first", "_last")
        )
        met = at.join(near, ["_band2", "_cell2"]).drop("_band2", "_cell2")
        return _bounds(met).where(F.col("_lo") <= self.radius)

    def small_boxes(self, open_: DataFrame) -> DataFrame:
        met = open_.select(*self.around, *_LARGE).join(self.small, [*_LARGE])
        return _bounds(met).where(F.col("_lo") <= self.radius)

    def single_points(self, open_: DataFrame) -> DataFrame:
        met = open_.select(*self.around, *_SMALL).join(self.points, [*_SMALL])
        return met.withColumn("_km", _to_point()).where(F.col("_km") <= self.radius)


def _to_point() -> Column:
    return haversine_km(F.col("_at_lat"), F.col("_at_lon"), F.col("_lat"), F.col("_lon"))


def _opened(left: DataFrame, right: DataFrame, box: Sequence[str], closed: Column) -> DataFrame:
    """Left rows with what their box holds; those that are closed stay as they are."""
    inner = right.withColumnsRenamed({c: f"{c}_in" for c in box})
    meets = all_of(F.col(c) == F.col(f"{c}_in") for c in box)
    return left.join(inner, meets & ~closed, "left").drop(*(f"{c}_in" for c in box))


def count_within_km(
    left: DataFrame, right: DataFrame, radius_km: float, key: Sequence[str],
    left_at: tuple[str, str] = ("latitude", "longitude"), right_at: tuple[str, str] = ("plat", "plon"),
) -> DataFrame:
    """``*key, n_points``: how many rows of ``right`` are at most ``radius_km`` away, for the rows of ``left`` with any.

    ``key`` tells the rows of ``left`` apart.  Boxes wholly inside the radius are added as counts;
    distances are measured in the boxes at its rim only.  Rows without a position count nowhere.
    """
    meeting = _Meeting(left, right.select(*right_at), radius_km, key, left_at, right_at)
    whole = F.coalesce("_whole", F.lit(False))
    # one chain of joins: a box that is wholly inside goes through it as it is
    met = meeting.large_boxes().withColumns({"_whole": F.col("_hi") <= radius_km, "_counted": F.col("_n")}).drop("_n", "_lo", "_hi")
    met = _bounds(_opened(met, meeting.small, _LARGE, whole)).where(whole | (F.col("_lo") <= radius_km))
    inside = {"_counted": F.when(whole, F.col("_counted")).otherwise(F.col("_n")), "_whole": whole | (F.col("_hi") <= radius_km)}
    met = met.withColumns(inside).drop("_n", "_lo", "_hi")
    met = _opened(met, meeting.points.select("_lat", "_lon", *_SMALL), _SMALL, whole)
    near = F.when(whole, F.col("_counted")).when(_to_point() <= radius_km, F.lit(1).cast("long"))
    return met.groupBy(*key).agg(F.sum(near).alias("n_points")).where("n_points > 0")


def _open_for_nearest(boxes: DataFrame, around: Sequence[str], box: Sequence[str], k: int) -> DataFrame:
    """The boxes that may hold one of the ``k`` nearest: not farther than the farthest way to ``k`` points.

    The rows of a place are its boxes, whose number the grid bounds.
    """
    here = Window.partitionBy(*around)
    seen = F.sum("_n").over(here.orderBy("_hi").rowsBetween(Window.unboundedPreceding, 0))
    enough = boxes.withColumn("_enough", F.when(seen >= k, F.col("_hi")))
    reached = F.coalesce(F.min("_enough").over(here), F.lit(math.inf))
    return enough.withColumn("_reached", reached).where("_lo <= _reached").select(*around, *box)


def nearest_within_km(
    left: DataFrame, right: DataFrame, radius_km: float, key: Sequence[str], id: str, k: int = 1,
    left_at: tuple[str, str] = ("latitude", "longitude"), right_at: tuple[str, str] = ("plat", "plon"),
) -> DataFrame:
    """``*key, rank, id, distance_km``: the ``k`` nearest rows of ``right`` within the radius, ties to smaller ids.

    Rows of ``right`` at one position count as ``k`` at most, those with the smallest ids.
    """
    here = F.row_number().over(Window.partitionBy(*right_at).orderBy(id))
    few = right.select(F.col(id), *right_at).dropna(subset=list(right_at)).withColumn("_here", here).where(F.col("_here") <= k).drop("_here")
    meeting = _Meeting(left, few, radius_km, key, left_at, right_at)
    large = _open_for_nearest(meeting.large_boxes(), meeting.around, _LARGE, k)
    small = _open_for_nearest(meeting.small_boxes(large), meeting.around, _SMALL, k)
    found = meeting.single_points(small)
    rank = F.row_number().over(Window.partitionBy(*key).orderBy("_km", id))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select(*key, "rank", id, F.col("_km").alias("distance_km"))


def nearest(
    left: DataFrame, right: DataFrame, key: Sequence[str], id: str, k: int = 1,
    left_at: tuple[str, str] = ("latitude", "longitude"), right_at: tuple[str, str] = ("plat", "plon"),
    first_km: float = 10.0, growth: float = 4.0,
) -> DataFrame:
    """``*key, rank, id, distance_km``: the ``k`` nearest rows of ``right``, however far, for every row of ``left`` with a position.

    Rings grow until they close: a row that has found ``k`` within the radius is settled, as nothing
    outside is nearer; the others look again in a wider ring, at most half-way round the globe, so after
    some ten rounds at the most.  A round is written to the shared folder; the driver sees whether rows are left.
    """
    todo = left.dropna(subset=list(left_at)).select(*key, *left_at)
    radius, done = min(first_km, HALF_ROUND_KM), []
    while True:
        last = radius >= HALF_ROUND_KM
        # nothing is farther away than half-way round; let rounding not make it so
        found = cut(nearest_within_km(todo, right, radius + last, key, id, k, left_at, right_at))
        if last:
            return _all([*done, found])
        settled = found.where(F.col("rank") == k).select(*key)
        done.append(found.join(settled, [*key], "left_semi"))
        todo = cut(todo.join(settled, [*key], "left_anti"))
        if todo.isEmpty():
            return _all(done)
        radius = min(radius * growth, HALF_ROUND_KM)


def _all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
