import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.functions.geo import EARTH_RADIUS_KM, haversine_km

_KM_PER_DEGREE = math.pi * EARTH_RADIUS_KM / 180
_MARGIN = 1.001  # cells a little larger than needed, against rounding at the edges


class Grid:
    """Latitude bands as high as the radius, each cut into equal longitude cells.

    The cells of a band are at least as wide as the radius reaches in longitude
    at the highest latitude of the band and its neighbours, so two points within
    the radius are always in the same or adjacent cells — also across the
    antimeridian, and near the poles, where a band is one single cell.

    All arguments are SQL text.  The expressions are null-free by construction (rows without a position are
    dropped before): the join would otherwise add null checks on its keys that
    evaluate all of this a second time.
    """

    def __init__(self, radius_km: float):
        self.height = radius_km * _MARGIN / _KM_PER_DEGREE

    def band(self, lat: str) -> str:
        return f"coalesce(floor({lat} / {self.height!r}D), 0L)"

    def cells(self, band: str) -> str:
        """How many cells go round the globe: 360° / (height / cos(latitude))."""
        edge = f"greatest(abs({band} - 1), abs({band} + 2)) * {self.height!r}D"
        top = f"radians(least({edge} + {self.height!r}D, 90D))"
        return f"greatest(floor(cos({top}) * {360 / self.height / _MARGIN!r}D), 1L)"

    def cell(self, lon: str, cells: str) -> str:
        return f"coalesce(pmod(floor(({lon} + 180D) / 360D * {cells}), {cells}), 0L)"


def within_km(
    left: DataFrame,
    right: DataFrame,
    radius_km: float,
    left_at: tuple[str, str] = ("latitude", "longitude"),
    right_at: tuple[str, str] = ("plat", "plon"),
    how: str = "inner",
) -> DataFrame:
    """Rows of ``left`` and ``right`` at most ``radius_km`` apart.

    ``how="inner"`` gives all columns of both plus ``distance_km``;
    ``how="left_semi"`` gives the rows of ``left`` that have a partner.  Rows
    without a position have none.

    An equi-join on grid cells with the distance as residual condition, so it is
    a sort-merge join, never a product.  Only ``right`` is copied into the
    neighbouring cells: put the smaller table there.  The copies are never
    broadcast: Spark's size check sees the files of ``right``, compressed and
    before the copying, and would gather on the driver what is hundreds of times
    as large.  A crowded cell is split by the adaptive skew join.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"how must be 'inner' or 'left_semi', not {how!r}")
    grid = Grid(radius_km)

    a = (
        left.dropna(subset=list(left_at))
        .withColumn("_band", F.expr(grid.band(f"`{left_at[0]}`")))
        .withColumn("_cells", F.expr(grid.cells("_band")))
        .withColumn("_cell", F.expr(grid.cell(f"`{left_at[1]}`", "_cells")))
        .drop("_cells")
    )
    b = right.dropna(subset=list(right_at))
    if how == "left_semi":
        # Positions are all a semi join needs; copies of one add nothing.
        b = b.select(*right_at).distinct()
    around = "explode(array_distinct(transform(array(-1L, 0L, 1L), d -> pmod(_own + d, _cells))))"
    b = (
        b.withColumn("_own", F.expr(grid.band(f"`{right_at[0]}`")))
        .withColumn("_band2", F.expr("explode(array(_own - 1, _own, _own + 1))"))
        .withColumn("_cells", F.expr(grid.cells("_band2")))
        .withColumn("_own", F.expr(grid.cell(f"`{right_at[1]}`", "_cells")))
        .withColumn("_cell2", F.expr(around))
        .drop("_own", "_cells")
    )

    (lat1, lon1), (lat2, lon2) = (a[c] for c in left_at), (b[c] for c in right_at)
    distance = haversine_km(lat1, lon1, lat2, lon2)
    near = (
        F.expr("_band = _band2 AND _cell = _cell2")
        & (F.abs(lat1 - lat2) <= grid.height)
        & (distance <= radius_km)
    )
    joined = a.join(b.hint("merge"), near, how)
    if how == "left_semi":
        return joined.drop("_band", "_cell")
    return joined.withColumn("distance_km", distance).drop("_band", "_cell", "_band2", "_cell2")
