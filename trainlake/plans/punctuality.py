from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trainlake import schemas
from trainlake.functions import month_text, percent, whole_number, year_text
from trainlake.dataset import Dataset, clean

_COUNTERS = {
    "nb_train_prevu": "nb_train_prevu",
    "nb_annulation": "nb_annulation",
    "nb_train_retard": "nb_train_retard_arrivee",
    "nb_retard_sup_15": "nb_train_retard_sup_15",
    "nb_retard_sup_30": "nb_train_retard_sup_30",
}


def _fields() -> dict[str, Column]:
    counters = {c: whole_number(F.col(w), "int") for c, w in _COUNTERS.items()}
    optional = {c: F.coalesce(v, F.lit(0)) for c, v in counters.items()}
    return {
        "periode": F.col("date"),
        "gare_depart": F.col("gare_depart"),
        "gare_arrivee": F.col("gare_arrivee"),
        "nb_train_prevu": counters["nb_train_prevu"],
        "nb_annulation": optional["nb_annulation"],
        "nb_train_retard": optional["nb_train_retard"],
        "retard_moyen_min": F.col("retard_moyen_arrivee"),
        "nb_retard_sup_15": optional["nb_retard_sup_15"],
        "nb_retard_sup_30": optional["nb_retard_sup_30"],
        "pct_cause_externe": F.col("prct_cause_externe"),
        "pct_cause_infra": F.col("prct_cause_infra"),
        "pct_cause_materiel": F.col("prct_cause_materiel_roulant"),
        "ingested_at": F.col("ingested_at"),
    }


def _derived() -> dict[str, Column]:
    # DOUBLE before the subtraction: two large INT counters may overflow.
    planned, cancelled, late = (
        F.col(c).cast("double") for c in ("nb_train_prevu", "nb_annulation", "nb_train_retard")
    )
    return {
        "taux_regularite_pct": percent(planned - cancelled - late, planned),
        "taux_annulation_pct": percent(cancelled, planned),
        "annee": year_text(F.col("periode")),
        "mois": month_text(F.col("periode")),
    }


def _rules() -> dict[str, Column]:
    return {"no_planned_train": F.col("nb_train_prevu") > 0}


def _checks() -> dict[str, Column]:
    return {"impossible_rate": F.col("taux_regularite_pct").between(0, 100)}


PUNCTUALITY = Dataset(
    name="regularite",
    wire=schemas.PUNCTUALITY_WIRE,
    silver=schemas.PUNCTUALITY_SILVER,
    key=("periode", "gare_depart", "gare_arrivee"),
    required=("periode", "gare_depart", "nb_train_prevu"),
    fields=_fields,
    derived=_derived,
    rules=_rules,
    checks=_checks,
    partition_by=("periode",),
    counters={w: "int" for w in _COUNTERS.values()},
)


def clean_punctuality(
    raw: DataFrame, keep: str = "first", validate_first: bool = False
) -> DataFrame:
    """Monthly punctuality and cancellation rates per connection."""
    return clean(PUNCTUALITY, raw, keep, validate_first)
