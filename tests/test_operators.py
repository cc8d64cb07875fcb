import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from trainlake.functions import haversine_km
from trainlake.operators import first_rows, keep_one, parse_json, require, within_km


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- parse ------------------------------------------------------------------


def test_parse_keeps_good_fields_of_a_record_with_a_bad_one(raw):
    df = parse_json(raw({"a": 1, "b": "x"}, {"a": "one", "b": "y"}, '{"a":'), "a INT, b STRING")
    assert rows(df) == sorted([(1, "x"), (None, "y"), (None, None)], key=repr)


def test_parse_reads_each_record_once(raw, plan):
    df = parse_json(raw({"a": 1}), "a INT, b INT").where("a > 0 AND b IS NOT NULL AND b < 9")
    assert plan(df).count("from_json") == 1


def test_parse_array_for_a_string_field_is_kept_as_text(raw):
    assert rows(parse_json(raw({"a": ["87", "88"]}), "a STRING")) == [('["87","88"]',)]


# -- filters ----------------------------------------------------------------


def test_require(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b"), (3, None)], "x INT, y STRING")
    assert rows(require(df, "x", "y")) == [(1, "a")]


def test_first_rows_is_a_top_k(spark, plan):
    df = spark.range(1000).withColumn("k", -F.col("id"))
    top = first_rows(df, ["k"], 3)
    assert [r.id for r in top.collect()] == [999, 998, 997]
    assert "TakeOrderedAndProject" in plan(top)


# -- dedup ------------------------------------------------------------------

RECORD = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.none(), st.integers(0, 3)),
    st.integers(0, 3),
)
SCHEMA = "k STRING, t INT, v INT"


def expected(records, keep):
    best = {}
    for k, t, v in records:
        sign = 1 if keep == "first" else -1
        rank = (t is None, sign * (t or 0), sign * v)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, t, v))
    return sorted((r for _, r in best.values()), key=repr)


@settings(max_examples=15, deadline=None)
@given(st.lists(RECORD, min_size=1, max_size=12), st.sampled_from(["first", "last"]), st.randoms())
def test_keep_one_is_order_independent_and_incremental(spark, records, keep, rnd):
    def kept(some):
        return keep_one(some, ["k"], ["t"], keep)

    df = spark.createDataFrame(records, SCHEMA)
    shuffled = records[:]
    rnd.shuffle(shuffled)
    again = spark.createDataFrame(shuffled, SCHEMA).repartition(3)
    wanted = expected(records, keep)
    assert rows(kept(df)) == wanted
    assert rows(kept(again)) == wanted
    # Merging a part that was already reduced gives the same result.
    half = spark.createDataFrame(records[: len(records) // 2], SCHEMA)
    assert rows(kept(kept(half).union(df))) == wanted


def test_keep_one_ships_one_row_per_key_and_task(spark, plan):
    text = plan(keep_one(spark.createDataFrame([("a", 1, 2)], SCHEMA), ["k"], ["t"]))
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("Exchange hashpartitioning(k") < text.index("Partial")


def test_keep_one_hot_key(spark):
    """A third of all rows share one key: it reaches the shuffle once per task."""
    df = spark.range(0, 300_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("t")
    )
    kept = keep_one(df, ["k"], ["t"])
    assert kept.count() == 200_001
    assert kept.where("k = -1").first().t == 0


def test_keep_one_rejects_other_words(spark):
    with pytest.raises(ValueError):
        keep_one(spark.range(1), ["id"], [], "any")


# -- spatial ----------------------------------------------------------------


def brute_force(left, right, radius):
    km = haversine_km(F.col("lat"), F.col("lon"), F.col("plat"), F.col("plon"))
    return {(r.a, r.b) for r in left.crossJoin(right).where(km <= radius).collect()}


def scattered(spark, rnd, lat, lon, n=150):
    def some(names):
        points = [(i, rnd.uniform(*lat), rnd.uniform(*lon)) for i in range(n)]
        return spark.createDataFrame(points, names)

    return some("a INT, lat DOUBLE, lon DOUBLE"), some("b INT, plat DOUBLE, plon DOUBLE")


@pytest.mark.parametrize(
    "lat, lon, radius",
    [
        ((41, 52), (-5.5, 10), 50.0),
        ((44.5, 45.5), (-1, 1), 10.0),
        ((44.9, 45.1), (-0.1, 0.1), 1.0),
        ((-1, 1), (-1, 1), 25.0),  # equator
        ((60, 62), (178, 180), 40.0),  # dateline, one side
        ((88.5, 90), (-180, 180), 60.0),  # pole
        ((-90, -88.5), (-180, 180), 60.0),
        ((-90, 90), (-180, 180), 2000.0),
    ],
)
def test_within_km_equals_brute_force(spark, lat, lon, radius):
    left, right = scattered(spark, random.Random(7), lat, lon)
    wanted = brute_force(left, right, radius)
    pairs = within_km(left, right, radius, ("lat", "lon")).collect()
    assert len(pairs) == len(wanted) > 0
    assert {(r.a, r.b) for r in pairs} == wanted
    semi = within_km(left, right, radius, ("lat", "lon"), how="left_semi")
    assert semi.columns == left.columns
    assert sorted(r.a for r in semi.collect()) == sorted({a for a, _ in wanted})


def test_within_km_across_the_dateline(spark):
    left = spark.createDataFrame([(1, 10.0, 179.99), (2, 10.0, -179.99), (3, 10.0, 180.0)],
                                 "a INT, lat DOUBLE, lon DOUBLE")
    right = left.toDF("b", "plat", "plon")
    found = {(r.a, r.b) for r in within_km(left, right, 5.0, ("lat", "lon")).collect()}
    assert found == {(i, j) for i in (1, 2, 3) for j in (1, 2, 3)}


def test_within_km_at_cell_edges(spark):
    """Points just inside and outside the radius, in all directions."""
    radius, centre = 10.0, (45.0, 1.0)
    around = []
    for i in range(72):
        for j, r in enumerate((radius * 0.9999, radius * 1.0001)):
            angle = math.radians(5 * i)
            dlat = r / 111.19492664 * math.cos(angle)
            dlon = r / 111.19492664 * math.sin(angle) / math.cos(math.radians(centre[0]))
            around.append((2 * i + j, centre[0] + dlat, centre[1] + dlon))
    left = spark.createDataFrame([(0, *centre)], "a INT, lat DOUBLE, lon DOUBLE")
    right = spark.createDataFrame(around, "b INT, plat DOUBLE, plon DOUBLE")
    found = {(r.a, r.b) for r in within_km(left, right, radius, ("lat", "lon")).collect()}
    assert found == brute_force(left, right, radius)


def test_within_km_ignores_rows_without_position(spark):
    left = spark.createDataFrame([(1, None, 1.0), (2, 0.0, 0.0)], "a INT, lat DOUBLE, lon DOUBLE")
    right = spark.createDataFrame([(1, 0.0, None), (2, 0.0, 0.0)], "b INT, plat DOUBLE, plon DOUBLE")
    assert [(r.a, r.b) for r in within_km(left, right, 1.0, ("lat", "lon")).collect()] == [(2, 2)]


def test_within_km_plans_an_equi_join(spark, plan):
    left, right = scattered(spark, random.Random(1), (44, 45), (0, 1), 20)
    for how in ("inner", "left_semi"):
        for threshold in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            try:
                text = plan(within_km(left, right, 10.0, ("lat", "lon"), how=how))
            finally:
                spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
            assert "Cartesian" not in text and "NestedLoop" not in text
            assert "SortMergeJoin" in text or "HashJoin" in text


def test_within_km_never_gathers_the_copies_on_the_driver(spark, plan, tmp_path):
    """Files that look small enough for a broadcast: points read from them are copied ninefold first."""
    left, right = scattered(spark, random.Random(2), (44, 45), (0, 1), 20)
    right.write.parquet(f"{tmp_path}/points")
    stored = spark.read.parquet(f"{tmp_path}/points")
    for how in ("inner", "left_semi"):
        found = within_km(left, stored, 30.0, ("lat", "lon"), how=how)
        assert "SortMergeJoin" in plan(found) and "BroadcastHashJoin" not in plan(found)
        rows = found.collect()
        assert rows and "Broadcast" not in plan(found)
        assert sorted(rows) == sorted(within_km(left, right, 30.0, ("lat", "lon"), how=how).collect())


def test_a_crowded_cell_is_split(spark):
    """A third of the points in one cell: the adaptive skew join divides them."""
    left = spark.range(0, 60_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(45.0)).otherwise(41 + F.col("id") % 1000 / 100).alias("lat"),
        F.when(F.col("id") % 3 == 0, F.lit(0.0)).otherwise(F.col("id") % 800 / 100).alias("lon"),
    )
    right = spark.createDataFrame([(1, 45.0, 0.01), (2, 48.0, 2.0)], "b INT, plat DOUBLE, plon DOUBLE")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        counts = within_km(left, right, 5.0, ("lat", "lon")).groupBy("b").count()
        assert counts.where("b = 1").first()["count"] >= 20_000
        counts.collect()
        final = counts._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in conf:
            spark.conf.unset(k)
    assert "skew=true" in final
