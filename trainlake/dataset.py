"""How a raw record becomes a silver row, declared once per dataset.

A cleaned table is always the same four steps::

    typed  → keep_one → derived → check
    parse, name,        new       drop rows whose
    cast, filter        columns   result is impossible

``typed`` and ``derived`` are row-wise, so they run inside the scan stage and on
streams alike; ``keep_one`` is the only shuffle.  ``check`` comes after
``keep_one``: a bad first copy hides a later good one unless ``validate_first``.
"""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trainlake.operators import keep_one, parse_json, require
from trainlake.operators.filters import all_of

Columns = Callable[[], dict[str, Column]]


def _none() -> dict[str, Column]:
    return {}


@dataclass(frozen=True)
class Dataset:
    name: str
    wire: str
    silver: str
    key: tuple[str, ...]
    required: tuple[str, ...]
    #: silver name → expression over the wire fields
    fields: Columns
    #: silver name → expression over ``fields``; computed after dedup
    derived: Columns = _none
    #: name → rule a row must pass before dedup; failing it is a defect
    rules: Columns = _none
    #: rows outside are not wanted, though not defective
    scope: Callable[[], Column] | None = None
    #: name → rule on the derived columns
    checks: Columns = _none
    order: tuple[str, ...] = ("ingested_at",)
    partition_by: tuple[str, ...] = ()
    #: which report of a key a stored table holds: the ``first`` or the ``last``
    keep: str = "first"
    #: wire field → integer type its value must fit
    counters: dict[str, str] = field(default_factory=dict)

    def named(self, records: DataFrame, *keep: str) -> DataFrame:
        """Wire columns → silver names and types, all rows kept."""
        return records.select(*keep, *(c.alias(n) for n, c in self.fields().items()))

    def typed(self, raw: DataFrame) -> DataFrame:
        """``json_str`` → typed rows that are complete and within bounds."""
        rows = require(self.named(parse_json(raw, self.wire)), *self.required)
        conditions = [*self.rules().values()]
        if self.scope is not None:
            conditions.append(self.scope())
        return rows.where(all_of(conditions)) if conditions else rows

    def derive(self, typed: DataFrame) -> DataFrame:
        return typed.withColumns(self.derived()) if self.derived() else typed

    def check(self, derived: DataFrame) -> DataFrame:
        checks = self.checks()
        return derived.where(all_of(checks.values())) if checks else derived

    def keep_one(self, rows: DataFrame, keep: str | None = None) -> DataFrame:
        """One row per business key (``keep``: as declared); only typed columns settle ties."""
        ties = [c for c in self.fields() if c not in {*self.key, *self.order}]
        return keep_one(rows, self.key, self.order, keep or self.keep, ties)


def clean(
    dataset: Dataset,
    raw: DataFrame,
    keep: str = "first",
    validate_first: bool = False,
    stamp: bool = True,
) -> DataFrame:
    """Raw ``json_str`` records → the silver table (batch)."""
    rows = dataset.typed(raw)
    if validate_first:
        rows = dataset.check(dataset.derive(rows)).select(*dataset.fields())
    rows = dataset.check(dataset.derive(dataset.keep_one(rows, keep)))
    return rows.withColumn("processed_at", F.current_timestamp()) if stamp else rows


def assessed(dataset: Dataset, raw: DataFrame) -> DataFrame:
    """Every record with its silver fields, whether they are kept (as in ``Dataset.typed``), and what is wrong with it.

    ``json_str``, the fields, ``_kept``, and ``_reason``: NULL, or the first that matches of ``unreadable``
    (nothing could be parsed), ``bad_field`` (a field has the wrong type and was read as NULL),
    ``overflow:<field>``, ``missing:<column>``, or the name of the broken rule.  A record may be kept and have a reason.
    Each record is parsed once.
    """
    wire = f"{dataset.wire}, _corrupt_record STRING"
    parsed = parse_json(raw.select("json_str"), wire, "json_str")
    fields = [f.name for f in StructType.fromDDL(dataset.wire).fields]
    rows = dataset.named(parsed, "json_str", "_corrupt_record", *[
        F.struct(*fields).alias("_wire")
    ]).withColumns(dataset.derived())
    wire_field = {n: F.col(f"_wire.{n}") for n in fields}

    reasons = [
        ("unreadable", all_of(c.isNull() for c in wire_field.values())),
        ("bad_field", F.col("_corrupt_record").isNotNull()),
    ]
    reasons += [
        (f"overflow:{n}", wire_field[n].isNotNull() & wire_field[n].try_cast(t).isNull())
        for n, t in dataset.counters.items()
    ]
    reasons += [(f"missing:{c}", F.col(c).isNull()) for c in dataset.required]
    broken = {**dataset.rules(), **dataset.checks()}
    reasons += [(name, ~F.coalesce(rule, F.lit(False))) for name, rule in broken.items()]
    reason = F.coalesce(*(F.when(hit, F.lit(name)) for name, hit in reasons))
    wanted = [F.col(c).isNotNull() for c in dataset.required] + [*dataset.rules().values()]
    if dataset.scope is not None:
        wanted.append(dataset.scope())
    kept = F.coalesce(all_of(wanted), F.lit(False))
    return rows.select("json_str", *dataset.fields(), kept.alias("_kept"), reason.alias("_reason"))


def quarantine(dataset: Dataset, raw: DataFrame) -> DataFrame:
    """``(json_str, reason)`` of every record that :func:`clean` drops or degrades, as :func:`assessed` finds it.

    Rows that are merely out of scope, and extra copies, are not defects.
    """
    return assessed(dataset, raw).where("_reason IS NOT NULL").select("json_str", F.col("_reason").alias("reason"))
