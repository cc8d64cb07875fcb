"""Cutting a region's records out of national, landed data."""

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake import schemas
from trainlake.dataset import quarantine
from trainlake.functions import in_box
from trainlake.operators import parse_json
from trainlake.plans.registry import DATASETS


def regional_stations(
    records: DataFrame,
    lat_range: tuple[float, float] = schemas.REGION_LAT,
    lon_range: tuple[float, float] = schemas.REGION_LON,
) -> DataFrame:
    """Station records inside the regional box; the meridian (0.0) is inside too."""
    at = F.col("position_geographique")
    return records.where(in_box(at["lat"], at["lon"], lat_range, lon_range))


def ridership_of(records: DataFrame, stations: DataFrame) -> DataFrame:
    """Ridership records of the given stations.

    Spark broadcasts the distinct codes if they pass its own size check, and
    shuffles both sides on the code otherwise.  Records without a code match
    nothing.
    """
    keys = stations.select(F.col("codes_uic").alias("code_uic_complet")).distinct()
    return records.join(keys, "code_uic_complet", "left_semi").select(*records.columns)


def upcoming_on_axes(
    records: DataFrame,
    axes: Sequence[str] = (schemas.MAIN_AXIS,),
    as_of: date | str | None = None,
) -> DataFrame:
    """All availability records on some axes from ``as_of`` on (today in UTC if not given).

    The date is compared as text, as the wire has it.
    """
    if as_of is None:
        today = F.convert_timezone(
            F.current_timezone(), F.lit("UTC"), F.current_timestamp().cast("timestamp_ntz")
        )
        start = F.date_format(today, "yyyy-MM-dd")
    else:
        start = F.lit(str(as_of))
    return records.where(F.col("axe").isin(*axes) & (F.col("date") >= start))


def punctuality_from(records: DataFrame, part_of_name: str = schemas.MAIN_STATION) -> DataFrame:
    """Punctuality records whose departure station contains ``part_of_name``."""
    return records.where(F.col("gare_depart").contains(part_of_name))


def regional_extract(
    stations: DataFrame,
    ridership: DataFrame,
    availability: DataFrame,
    punctuality: DataFrame,
    as_of: date | str | None = None,
    axes: Sequence[str] = (schemas.MAIN_AXIS,),
    station: str = schemas.MAIN_STATION,
    lat_range: tuple[float, float] = schemas.REGION_LAT,
    lon_range: tuple[float, float] = schemas.REGION_LON,
) -> dict[str, DataFrame]:
    """The four record sets of the region, by dataset name (all lazy)."""
    local = regional_stations(stations, lat_range, lon_range)
    return {
        "gares": local,
        "frequentation": ridership_of(ridership, local),
        "tgvmax": upcoming_on_axes(availability, axes, as_of),
        "regularite": punctuality_from(punctuality, station),
    }


def regional_records(
    raw: Mapping[str, DataFrame], as_of: date | str | None = None, **region
) -> dict[str, DataFrame]:
    """``regional_extract`` on raw records: parsed for the filters only, ``json_str`` kept whole.

    ``region`` takes the axes, the station and the box of :func:`regional_extract`.
    """
    names = ("gares", "frequentation", "tgvmax", "regularite")
    parsed = (parse_json(raw[n], DATASETS[n].wire, "json_str") for n in names)
    found = regional_extract(*parsed, as_of, **region)
    return {n: df.select("json_str", *MESSAGE_KEYS[n]) for n, df in found.items()}


def unparsed_records(raw: DataFrame, name: str) -> DataFrame:
    """``json_str, reason`` of records that no filter can judge: unreadable, or a field of the wrong type."""
    return quarantine(DATASETS[name], raw).where("reason IN ('unreadable', 'bad_field')")


# The fields each dataset's message key is made of.
MESSAGE_KEYS = {
    "gares": ("codes_uic",),
    "frequentation": ("code_uic_complet",),
    "tgvmax": ("train_no", "date"),
    "regularite": ("date",),
}
