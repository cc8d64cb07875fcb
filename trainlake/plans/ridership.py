from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake import schemas
from trainlake.functions import not_negative, pct_change, title_case, whole_number
from trainlake.dataset import Dataset, clean

YEARS = (2024, 2023, 2022, 2019)


def _fields() -> dict[str, Column]:
    travellers = {
        f"voyageurs_{y}": not_negative(whole_number(F.col(f"total_voyageurs_{y}")))
        for y in YEARS
    }
    return {
        "nom_gare": title_case(F.col("nom_gare")),
        "code_uic": F.col("code_uic_complet"),
        "code_postal": F.col("code_postal"),
        "segment_drg": F.col("segmentation_drg"),
        **travellers,
        "ingested_at": F.col("ingested_at"),
    }


def _derived() -> dict[str, Column]:
    change = pct_change(F.col("voyageurs_2024"), F.col("voyageurs_2019"))
    return {"evolution_pct_2019_2024": change}


RIDERSHIP = Dataset(
    name="frequentation",
    wire=schemas.RIDERSHIP_WIRE,
    silver=schemas.RIDERSHIP_SILVER,
    key=("code_uic",),
    required=("nom_gare", "code_uic"),
    fields=_fields,
    derived=_derived,
    counters={f"total_voyageurs_{y}": "bigint" for y in YEARS},
)


def clean_ridership(raw: DataFrame, keep: str = "first") -> DataFrame:
    """Yearly travellers per station, with the change from 2019 to 2024."""
    return clean(RIDERSHIP, raw, keep)
