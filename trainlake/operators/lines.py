"""Distances from places to routes: lines of great-circle segments, not just their points."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trainlake.functions.geo import EARTH_RADIUS_KM
from trainlake.operators.spatial import Grid

#: Columns of a segment: where it starts and ends.
ENDS = ("from_lat", "from_lon", "to_lat", "to_lon")
_AXES = ("x", "y", "z")


def route_segments(points: DataFrame, route: Sequence[str], order: Sequence[str], at: tuple[str, str] = ("plat", "plon")) -> DataFrame:
    """``*route`` and ``ENDS`` of the segments between consecutive points of each route.

    Points without a position are left out; a route of one point is a segment without length.
    """
    along = Window.partitionBy(*route).orderBy(*order)
    lat, lon = (F.col(c).cast("double") for c in at)
    next_lat, next_lon = (F.lead(c).over(along) for c in (lat, lon))
    alone = (F.row_number().over(along) == 1) & next_lat.isNull()
    rows = points.dropna(subset=list(at)).select(
        *route, lat.alias("from_lat"), lon.alias("from_lon"),
        F.when(alone, lat).otherwise(next_lat).alias("to_lat"), F.when(alone, lon).otherwise(next_lon).alias("to_lon"),
    )
    return rows.where("to_lat IS NOT NULL")


def _vector(name: str, lat: str, lon: str) -> dict[str, Column]:
    """The unit vector of a position, as three columns."""
    phi, lam = F.radians(F.col(lat).cast("double")), F.radians(F.col(lon).cast("double"))
    return dict(zip((f"{name}{a}" for a in _AXES), (F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi)), strict=True))


def _cross(name: str, a: str, b: str) -> dict[str, Column]:
    ax, ay, az, bx, by, bz = (F.col(v + c) for v in (a, b) for c in _AXES)
    return dict(zip((f"{name}{c}" for c in _AXES), (ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx), strict=True))


def _dot(a: str, b: str) -> Column:
    x, y, z = (F.col(a + c) * F.col(b + c) for c in _AXES)
    return x + y + z


def _apart(a: str, b: str) -> Column:
    """The angle between two unit vectors, exact also where it is small."""
    x, y, z = ((F.col(a + c) - F.col(b + c)) * (F.col(a + c) - F.col(b + c)) for c in _AXES)
    return F.asin(F.least(F.sqrt(x + y + z) / 2, F.lit(1.0))) * 2


def _prepared(lines: DataFrame) -> DataFrame:
    """Segments with their ends as vectors, the pole of their great circle, and the planes through the ends that limit them.

    ``_arc`` says whether there is a great circle: not if the ends are equal or opposite.
    """
    rows = lines.dropna(subset=list(ENDS)).withColumns(_vector("_a", *ENDS[:2]) | _vector("_b", *ENDS[2:]))
    rows = rows.withColumns(_cross("_n", "_a", "_b"))
    size = F.sqrt(_dot("_n", "_n"))
    rows = rows.withColumn("_size", size).withColumn("_arc", F.col("_size") > 1e-12)
    rows = rows.withColumns({f"_n{c}": F.when(F.col("_arc"), F.col(f"_n{c}") / F.col("_size")).otherwise(0.0) for c in _AXES})
    return rows.withColumns(_cross("_s", "_n", "_a") | _cross("_e", "_b", "_n")).drop("_size")


def _distance_km() -> Column:
    """From the vector ``_p`` to a prepared segment: across where the foot lies on it, else to the nearer end."""
    on_it = F.col("_arc") & (_dot("_p", "_s") >= 0) & (_dot("_p", "_e") >= 0)
    across = F.asin(F.least(F.abs(_dot("_p", "_n")), F.lit(1.0)))
    return F.when(on_it, across).otherwise(F.least(_apart("_p", "_a"), _apart("_p", "_b"))) * EARTH_RADIUS_KM


def _laid_out(lines: DataFrame, grid: Grid, step_km: float) -> DataFrame:
    """Prepared segments, one row for each grid cell around them (``_band``, ``_cell``).

    A segment is cut into pieces of at most ``step_km``; the cell of each piece's middle and its eight
    neighbours are taken, each cell once.
    """
    angle = _apart("_a", "_b")
    pieces = F.greatest(F.ceil(angle * EARTH_RADIUS_KM / step_km), F.lit(1))
    rows = _prepared(lines).withColumns({"_angle": angle, "_pieces": F.when(F.col("_arc"), pieces).otherwise(F.lit(1))})
    middle = (
        "transform(sequence(0L, _pieces - 1L), i -> CASE WHEN _arc THEN transform(array((i + 0.5D) / _pieces * _angle), w -> "
        + "named_struct(" + ", ".join(f"'{c}', sin(_angle - w) * _a{c} + sin(w) * _b{c}" for c in _AXES) + "))[0]"
        + " ELSE named_struct('x', _ax, 'y', _ay, 'z', _az) END)"
    )
    # an end without a great circle stands for itself, so both ends are laid out
    rows = rows.withColumn("_at", F.expr(f"concat({middle}, array(named_struct('x', _bx, 'y', _by, 'z', _bz)))"))
    places = "transform(_at, v -> named_struct('lat', degrees(atan2(v.z, sqrt(v.x * v.x + v.y * v.y))), 'lon', degrees(atan2(v.y, v.x))))"
    rows = rows.withColumn("_at", F.expr(places))
    around = (
        "flatten(transform(_at, p -> flatten(transform(array(-1L, 0L, 1L), d -> "
        f"flatten(transform(array({grid.band('p.lat')} + d), b -> transform(array({grid.cells('b')}), n -> "
        f"transform(array(-1L, 0L, 1L), e -> named_struct('band', b, 'cell', pmod({grid.cell('p.lon', 'n')} + e, n)))))[0])))))"
    )
    rows = rows.withColumn("_over", F.explode(F.array_distinct(F.expr(around))))
    return rows.withColumns({"_band": F.col("_over.band"), "_cell": F.col("_over.cell")}).drop("_at", "_over", "_angle", "_pieces")


def _placed(places: DataFrame, grid: Grid, at: tuple[str, str]) -> DataFrame:
    rows = places.dropna(subset=list(at)).withColumns(_vector("_p", *at))
    rows = rows.withColumn("_band", F.expr(grid.band(f"`{at[0]}`"))).withColumn("_cells", F.expr(grid.cells("_band")))
    return rows.withColumn("_cell", F.expr(grid.cell(f"`{at[1]}`", "_cells"))).drop("_cells")


def _grid(radius_km: float) -> tuple[Grid, float]:
    """A grid for pieces as long as the radius: what is near a piece is within 1.5 radii of its middle."""
    return Grid(1.5 * radius_km), radius_km


def places_near_lines(places: DataFrame, lines: DataFrame, radius_km: float, at: tuple[str, str] = ("latitude", "longitude"), how: str = "inner") -> DataFrame:
    """Places and segments (``ENDS``) at most ``radius_km`` apart, by the distance to the line between the ends.

    ``how="inner"`` gives all columns of both and ``distance_km``, ``how="left_semi"`` the places that have a
    segment.  Rows without a position have none.  Segments of any length, also over the antimeridian and the
    poles, are laid over all cells they touch; of equal or opposite ends only the ends count.  An equi-join
    on cells: the segments are copied, so a crowded cell splits by its places.
    """
    if how not in ("inner", "left_semi"):
        raise ValueError(f"how must be 'inner' or 'left_semi', not {how!r}")
    grid, step = _grid(radius_km)
    a, b = _placed(places, grid, at), _laid_out(lines, grid, step)
    if how == "left_semi":
        b = b.drop(*lines.columns)
    b = b.withColumnsRenamed({"_band": "_band2", "_cell": "_cell2"})
    near = F.expr("_band = _band2 AND _cell = _cell2") & (_distance_km() <= radius_km)
    joined = a.join(b, near, how)
    if how == "left_semi":
        return joined.select(*places.columns)
    return joined.select(*places.columns, *lines.columns, _distance_km().alias("distance_km"))


def lines_near_places(lines: DataFrame, places: DataFrame, radius_km: float, at: tuple[str, str] = ("latitude", "longitude")) -> DataFrame:
    """The different segments that have a place within ``radius_km``; no pairs are formed."""
    grid, step = _grid(radius_km)
    b = _placed(places.select(*at).distinct(), grid, at).drop(*at).withColumnsRenamed({"_band": "_band2", "_cell": "_cell2"})
    near = F.expr("_band = _band2 AND _cell = _cell2") & (_distance_km() <= radius_km)
    return _laid_out(lines, grid, step).join(b, near, "left_semi").select(*lines.columns).distinct()
