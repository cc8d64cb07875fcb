from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake import schemas
from trainlake.functions import geo_cell, grid_degree, in_box, title_case
from trainlake.dataset import Dataset, clean


def _fields() -> dict[str, Column]:
    return {
        "nom_gare": title_case(F.col("nom")),
        "trigramme": F.col("libellecourt"),
        "codes_uic": F.col("codes_uic"),
        "segment_drg": F.col("segment_drg"),
        "code_insee": F.col("codeinsee"),
        "latitude": F.col("position_geographique.lat"),
        "longitude": F.col("position_geographique.lon"),
        "ingested_at": F.col("ingested_at"),
    }


def _derived() -> dict[str, Column]:
    lat, lon = F.col("latitude"), F.col("longitude")
    return {
        "lat_grid": grid_degree(lat),
        "lon_grid": grid_degree(lon),
        "geo_cell": geo_cell(lat, lon),
    }


def _rules() -> dict[str, Column]:
    box = in_box(
        F.col("latitude"), F.col("longitude"), schemas.COUNTRY_LAT, schemas.COUNTRY_LON
    )
    return {"outside_country": box}


STATIONS = Dataset(
    name="gares",
    wire=schemas.STATIONS_WIRE,
    silver=schemas.STATIONS_SILVER,
    key=("codes_uic",),
    required=("latitude", "longitude", "codes_uic"),
    fields=_fields,
    derived=_derived,
    rules=_rules,
)


def clean_stations(raw: DataFrame, keep: str = "first") -> DataFrame:
    """Stations with a position inside the country, one per UIC code."""
    return clean(STATIONS, raw, keep)
