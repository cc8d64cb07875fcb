"""Is everything there that should be?"""

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trainlake.dataset import Dataset
from trainlake.plans.registry import DATASETS
from trainlake.sources.pages import declared_totals
from trainlake.sources.tables import has_rows


class MissingData(Exception):
    pass


def missing_datasets(expected: DataFrame, present: DataFrame, on: str = "dataset") -> DataFrame:
    """Names in ``expected`` without a counterpart in ``present``.

    Both sides are reduced to distinct names first, so a name that fills a third
    of the rows crosses the join once.
    """
    return expected.select(on).distinct().join(present.select(on).distinct(), on, "left_anti")


def missing_silver(
    spark: SparkSession, base: str, datasets: Mapping[str, Dataset] = DATASETS
) -> DataFrame:
    """``dataset``: the names of the silver tables under ``base`` that have no row.

    One row is enough, so each check stops at the first row it finds.
    """
    expected = spark.createDataFrame([(n,) for n in datasets], "dataset STRING")
    found = [(n,) for n, d in datasets.items() if has_rows(spark, d, base)]
    return missing_datasets(expected, spark.createDataFrame(found, "dataset STRING"))


def audit_silver(
    spark: SparkSession, base: str, names: Iterable[str] | None = None
) -> dict[str, bool]:
    """Check that every expected table has at least one row; raise if one has none."""
    wanted = sorted(DATASETS if names is None else names)
    missing = missing_silver(spark, base, {n: DATASETS[n] for n in wanted}).collect()
    if missing:
        raise MissingData(f"no rows under {base} for: {', '.join(sorted(r.dataset for r in missing))}")
    return dict.fromkeys(wanted, True)


def page_completeness(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Per pull (directory) of landed pages: ``pull, expected, landed, torn, complete``.

    Complete: no page is torn, and as many different records landed as were declared.
    """
    totals = declared_totals(spark, path, multi_line)
    there = (F.col("landed") >= F.col("expected")) & (F.col("torn") == 0)
    return totals.withColumn("complete", F.coalesce(there, F.lit(False)))


def require_complete(spark: SparkSession, path: str, multi_line: bool = True) -> None:
    """Raise if any pull under ``path`` has a gap, or if there is none; names one of them."""
    pulls = page_completeness(spark, path, multi_line)
    gap = pulls.where("not complete").orderBy("pull").first()
    if gap is not None:
        raise MissingData(f"{gap.pull}: {gap.landed} of {gap.expected} records, {gap.torn} torn pages")
    if pulls.isEmpty():
        raise MissingData(f"no pages under {path}")
