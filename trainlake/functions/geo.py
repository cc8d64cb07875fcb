from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def in_box(
    lat: Column, lon: Column, lat_range: tuple[float, float], lon_range: tuple[float, float]
) -> Column:
    """Inside a latitude/longitude box, edges included.  NULL for a NULL position."""
    return lat.between(*lat_range) & lon.between(*lon_range)


def grid_degree(degree: Column, digits: int = 2) -> Column:
    """A coordinate rounded to the display grid."""
    return F.round(degree, digits)


def geo_cell(lat: Column, lon: Column, digits: int = 2) -> Column:
    """Display cell id such as ``44.84_-0.56``."""
    return F.concat(
        grid_degree(lat, digits).cast("string"),
        F.lit("_"),
        grid_degree(lon, digits).cast("string"),
    )


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance on a sphere of 6371 km; NULL if any coordinate is."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    # Rounding may push antipodes past 1; `least` would also turn NULL into 1.
    return F.asin(F.sqrt(F.when(a > 1, F.lit(1.0)).otherwise(a))) * (2 * EARTH_RADIUS_KM)
