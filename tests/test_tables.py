import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from trainlake.plans import audit_silver
from trainlake.plans.audit import MissingData
from trainlake.plans.availability import availability
from trainlake.plans.punctuality import PUNCTUALITY
from trainlake.plans.ridership import RIDERSHIP
from trainlake.plans.stations import STATIONS
from trainlake.sinks import append_lot, compact, write_snapshot
from trainlake.sources import Table, read_silver, text_source
from trainlake.sources.tables import ConcurrentWrite
from trainlake.streaming import AVAILABLE_NOW, refine_stream

SEEN = availability("2024-01-01")


def ridership(raw, **numbers):
    """One record per keyword: station code → travellers, stamped by that number."""
    records = [
        {"nom_gare": k, "code_uic_complet": k, "total_voyageurs_2024": v, "ingested_at": f"{v:04d}"}
        for k, v in numbers.items()
    ]
    return RIDERSHIP.typed(raw(*records))


LAST = replace(RIDERSHIP, keep="last")
KEEPING = {"first": RIDERSHIP, "last": LAST}


def found(spark, base, keep="first"):
    rows = read_silver(spark, KEEPING[keep], base).collect()
    assert len({r.code_uic for r in rows}) == len(rows)
    return {r.code_uic: r.voyageurs_2024 for r in rows}


def seats(raw, *days, flag="OUI"):
    return SEEN.typed(raw(*[
        {"date": d, "train_no": "1", "origine": "A", "destination": "B", "od_happy_card": flag}
        for d in days
    ]))


@pytest.mark.parametrize(
    "keep, wanted", [("first", {"a": 1, "b": 1, "c": 2}), ("last", {"a": 3, "b": 1, "c": 2})]
)
def test_snapshot_merges(spark, raw, tmp_path, keep, wanted):
    base = str(tmp_path)
    for batch in ({"a": 1, "b": 1}, {"a": 2, "c": 2}, {"a": 3}, {"a": 3}):
        rows = write_snapshot(ridership(raw, **batch), KEEPING[keep], base)
    assert found(spark, base) == wanted and rows == 3


def test_snapshot_can_replace(spark, raw, tmp_path):
    base = str(tmp_path)
    write_snapshot(ridership(raw, a=1, b=1), RIDERSHIP, base)
    write_snapshot(ridership(raw, c=2), RIDERSHIP, base, merge=False)
    assert found(spark, base) == {"c": 2}


def test_a_reader_survives_ten_versions_and_compaction_drops_by_age(spark, raw, tmp_path):
    base = str(tmp_path)
    write_snapshot(ridership(raw, a=0, z=0), LAST, base)
    reader = read_silver(spark, LAST, base)
    for n in range(1, 11):
        write_snapshot(ridership(raw, a=n), LAST, base)
    assert {r.voyageurs_2024 for r in reader.collect()} == {0}
    table = Table(spark, LAST, base)
    compact(spark, LAST, base, drop_after_hours=1)
    assert len(table._committed("v")) == 11
    compact(spark, LAST, base, drop_after_hours=0)
    assert table._committed("v") == ["00000010"] and found(spark, base, "last") == {"a": 10, "z": 0}


def test_of_two_writers_one_fails(spark, raw, tmp_path):
    base = str(tmp_path)
    write_snapshot(ridership(raw, a=1), RIDERSHIP, base)
    Table(spark, RIDERSHIP, base).claim(1, "one")
    with pytest.raises(ConcurrentWrite, match="one"):
        write_snapshot(ridership(raw, b=1), RIDERSHIP, base)
    # the holder itself may come again, as after a crash
    write_snapshot(ridership(raw, c=1), RIDERSHIP, base, owner="one")
    write_snapshot(ridership(raw, d=1), RIDERSHIP, base)
    assert set(found(spark, base)) == {"a", "c", "d"}


def test_tables_need_no_marker_of_the_committer(spark, raw, tmp_path):
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        write_snapshot(ridership(raw, a=1), RIDERSHIP, str(tmp_path))
        append_lot(ridership(raw, b=1), RIDERSHIP, str(tmp_path), "x")
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert set(found(spark, str(tmp_path))) == {"a", "b"}


def test_a_reader_keeps_its_version(spark, raw, tmp_path):
    base = str(tmp_path)
    write_snapshot(ridership(raw, a=1), RIDERSHIP, base)
    reader = read_silver(spark, RIDERSHIP, base)
    write_snapshot(ridership(raw, b=2), RIDERSHIP, base)
    assert reader.count() == 1 and len(found(spark, base)) == 2


def test_a_half_written_version_is_ignored_and_replaced(spark, raw, tmp_path):
    base = str(tmp_path)
    write_snapshot(ridership(raw, a=1), RIDERSHIP, base)
    torn = tmp_path / "frequentation" / "v=00000001"
    ridership(raw, x=9).write.parquet(str(torn))
    assert found(spark, base) == {"a": 1}
    write_snapshot(ridership(raw, b=2), RIDERSHIP, base)
    assert found(spark, base) == {"a": 1, "b": 2}


@pytest.mark.parametrize(
    "keep, wanted", [("first", {"a": 1, "b": 1, "c": 2}), ("last", {"a": 3, "b": 1, "c": 2})]
)
def test_lots_are_settled_on_read_and_by_compaction(spark, raw, tmp_path, keep, wanted):
    base = str(tmp_path)
    lots = {"x0": {"a": 1, "b": 1}, "x1": {"a": 2, "c": 2}, "x2": {"a": 3}}
    for lot, batch in lots.items():
        append_lot(ridership(raw, **batch), KEEPING[keep], base, lot)
    assert found(spark, base, keep) == wanted
    assert compact(spark, KEEPING[keep], base) == 3
    # Both the version and the lots are there, then the version alone.
    assert found(spark, base, keep) == wanted
    assert compact(spark, KEEPING[keep], base, drop_lots=True) == 3
    assert Table(spark, RIDERSHIP, base).lots() == []
    assert found(spark, base, keep) == wanted
    append_lot(ridership(raw, d=4), KEEPING[keep], base, "x3")
    assert found(spark, base, keep) == {**wanted, "d": 4}


def test_a_replayed_lot_replaces_itself(spark, raw, tmp_path):
    base = str(tmp_path)
    for _ in range(2):
        assert append_lot(ridership(raw, a=1, b=2), RIDERSHIP, base, "x") == 2
    assert spark.read.parquet(f"{base}/frequentation/lot=x").count() == 2


def test_an_impossible_rate_still_claims_its_key(spark, raw, tmp_path):
    def month(stamp, planned, cancelled, late):
        return PUNCTUALITY.typed(raw({
            "date": "2024-03", "gare_depart": "A", "gare_arrivee": "B", "ingested_at": stamp,
            "nb_train_prevu": planned, "nb_annulation": cancelled, "nb_train_retard_arrivee": late,
        }))

    bad, good = month("1", 5, 4, 3), month("2", 5, 1, 1)
    for n, batch in enumerate((bad, good)):
        write_snapshot(batch, PUNCTUALITY, f"{tmp_path}/s")
        append_lot(batch, PUNCTUALITY, f"{tmp_path}/l", str(n))
    assert read_silver(spark, PUNCTUALITY, f"{tmp_path}/s").count() == 0
    assert read_silver(spark, PUNCTUALITY, f"{tmp_path}/l").count() == 0
    assert read_silver(spark, replace(PUNCTUALITY, keep="last"), f"{tmp_path}/l").count() == 1
    for part in "sl":
        with pytest.raises(MissingData):
            audit_silver(spark, f"{tmp_path}/{part}", ["regularite"])


def test_text_partitions_keep_odd_values(spark, raw, plan, tmp_path):
    periods = ["", "2024-03", "2024", "a/b=c d"]
    months = [{"date": p, "gare_depart": "A", "nb_train_prevu": 5} for p in periods]
    for _ in range(2):
        write_snapshot(PUNCTUALITY.typed(raw(*months)), PUNCTUALITY, str(tmp_path))
    df = read_silver(spark, PUNCTUALITY, str(tmp_path))
    assert sorted(r.periode for r in df.collect()) == sorted(periods)
    scan = plan(df.where("periode = '2024-03'"))
    assert "PartitionFilters: [(coalesce(periode" in scan


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_partitioned_snapshot_prunes(spark, raw, plan, tmp_path, adaptive):
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        write_snapshot(seats(raw, "2024-01-06", "2024-01-07"), SEEN, str(tmp_path))
        assert (tmp_path / "tgvmax" / "v=00000000" / "date_depart=2024-01-07").is_dir()
        df = read_silver(spark, SEEN, str(tmp_path)).where("date_depart = DATE'2024-01-07'")
        text = plan(df.select("od"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert [r.od for r in df.collect()] == ["A->B"]
    scan = next(line for line in text.splitlines() if "FileScan" in line)
    assert "PartitionFilters: [isnotnull(date_depart" in scan
    assert "ReadSchema: struct<od:string>" in scan


def test_filters_on_the_key_pass_below_the_settling_of_lots(spark, raw, plan, tmp_path):
    append_lot(seats(raw, "2024-01-06", "2024-01-07"), SEEN, str(tmp_path), "x")
    df = read_silver(spark, SEEN, str(tmp_path)).where("date_depart = DATE'2024-01-07'")
    assert "GreaterThanOrEqual(date_depart" in plan(df) or "EqualTo(date_depart" in plan(df)
    assert df.count() == 1


def months(raw, *periods, trains=5, station="A"):
    return PUNCTUALITY.typed(raw(*[{"date": p, "gare_depart": station, "nb_train_prevu": trains, "ingested_at": "1"} for p in periods]))


def folders(base, version):
    return sorted(d.name for d in (base / "regularite" / f"v={version:08d}").iterdir() if d.is_dir())


def kept(spark, base):
    return sorted((r.periode, r.gare_depart, r.nb_train_prevu) for r in read_silver(spark, PUNCTUALITY, str(base)).collect())


def test_a_batch_rewrites_only_the_partitions_it_touches(spark, raw, tmp_path):
    write_snapshot(months(raw, "2024-01", "2024-02", "2024-03"), PUNCTUALITY, str(tmp_path))
    # nothing of the other months is read: they could not be
    for other in ("2024-01", "2024-03"):
        for file in (tmp_path / "regularite" / "v=00000000" / f"periode={other}").glob("*.parquet"):
            file.rename(file.with_suffix(".away"))
    assert write_snapshot(months(raw, "2024-02", station="B"), PUNCTUALITY, str(tmp_path)) == 2
    assert folders(tmp_path, 1) == ["periode=2024-02"]
    assert write_snapshot(months(raw, "2024-04"), PUNCTUALITY, str(tmp_path)) == 1
    assert folders(tmp_path, 2) == ["periode=2024-04"]
    for file in tmp_path.rglob("*.away"):
        file.rename(file.with_suffix(".parquet"))
    assert kept(spark, tmp_path) == [("2024-01", "A", 5), ("2024-02", "A", 5), ("2024-02", "B", 5), ("2024-03", "A", 5), ("2024-04", "A", 5)]


def test_merged_partitions_keep_odd_values_and_prune(spark, raw, plan, tmp_path):
    periods = ["", "2024-03", "a/b=c d", "x%2Fy", "é{1}*[2]?"]
    write_snapshot(months(raw, *periods), PUNCTUALITY, str(tmp_path))
    for p in ("a/b=c d", "", "é{1}*[2]?"):
        write_snapshot(months(raw, p, station="B"), PUNCTUALITY, str(tmp_path))
    assert kept(spark, tmp_path) == sorted([(p, "A", 5) for p in periods] + [(p, "B", 5) for p in ("a/b=c d", "", "é{1}*[2]?")])
    df = read_silver(spark, PUNCTUALITY, str(tmp_path)).where("periode = '2024-03'")
    assert "PartitionFilters: [(coalesce(periode" in plan(df) and df.count() == 1
    assert df.dtypes == read_silver(spark, PUNCTUALITY, str(tmp_path / "none")).dtypes


def test_a_replayed_batch_is_not_written_again(spark, raw, tmp_path):
    for batch, months_ in enumerate((("2024-01", "2024-02"), ("2024-02", "2024-03"))):
        for _ in range(2):
            rows = write_snapshot(months(raw, *months_), PUNCTUALITY, str(tmp_path), owner="query", batch=batch)
            assert rows == 2
    table = Table(spark, PUNCTUALITY, str(tmp_path))
    assert table._committed("v") == ["00000000", "00000001"]
    # the same rows from another writer: the next version, with the same content
    before = kept(spark, tmp_path)
    write_snapshot(months(raw, "2024-02", "2024-03"), PUNCTUALITY, str(tmp_path))
    assert kept(spark, tmp_path) == before and table.version() == 2


def test_folders_in_use_survive_the_removal_of_their_version(spark, raw, tmp_path):
    base = str(tmp_path)
    write_snapshot(months(raw, "2024-01", "2024-02"), PUNCTUALITY, base)
    write_snapshot(months(raw, "2024-02", station="B"), PUNCTUALITY, base)
    write_snapshot(months(raw, "2024-02", station="C"), PUNCTUALITY, base)
    torn = tmp_path / "regularite" / "v=00000003" / "periode=2024-09"
    torn.mkdir(parents=True)
    before = kept(spark, tmp_path)
    table = Table(spark, PUNCTUALITY, base)
    table.drop_versions_older_than(0)
    assert table._committed("v") == ["00000002"] and kept(spark, tmp_path) == before
    assert folders(tmp_path, 0) == ["periode=2024-01"] and not (tmp_path / "regularite" / "v=00000001").exists()
    assert torn.is_dir()  # a writer at work
    write_snapshot(months(raw, "2024-01", station="B"), PUNCTUALITY, base)
    table.drop_versions_older_than(0)
    assert not (tmp_path / "regularite" / "v=00000000").exists() and folders(tmp_path, 2) == ["periode=2024-02"]
    assert [k[:2] for k in kept(spark, tmp_path)] == [("2024-01", "A"), ("2024-01", "B"), ("2024-02", "A"), ("2024-02", "B"), ("2024-02", "C")]


def test_a_stream_writes_the_partitions_of_its_batch(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    for n, period in enumerate(("2024-01", "2024-02", "2024-02")):
        (landed / f"{n}.json").write_text(json.dumps({"date": period, "gare_depart": str(n), "nb_train_prevu": 5}))
        refine_stream(text_source(spark, str(landed)), PUNCTUALITY, str(tmp_path), str(tmp_path / "checkpoint"), trigger=AVAILABLE_NOW).awaitTermination()
    assert [folders(tmp_path, n) for n in range(3)] == [["periode=2024-01"], ["periode=2024-02"], ["periode=2024-02"]]
    assert [k[1] for k in kept(spark, tmp_path)] == ["0", "1", "2"]


def test_missing_table_is_empty(spark, tmp_path):
    df = read_silver(spark, STATIONS, str(tmp_path))
    assert df.count() == 0
    assert df.dtypes == spark.createDataFrame([], STATIONS.silver).dtypes


def test_audit(spark, raw, tmp_path):
    base = str(tmp_path)
    write_snapshot(ridership(raw, a=1), RIDERSHIP, base)
    append_lot(seats(raw, "2024-01-06"), SEEN, base, "x")
    assert audit_silver(spark, base, ["frequentation", "tgvmax"]) == {
        "frequentation": True, "tgvmax": True,
    }
    write_snapshot(PUNCTUALITY.typed(raw("{}")), PUNCTUALITY, base)
    with pytest.raises(MissingData, match="gares, regularite"):
        audit_silver(spark, base)


def test_written_files_stay_few(spark, tmp_path):
    """Many keys over few partition values: files follow volume, not tasks."""
    days = spark.range(20_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 10).cast("int")).alias("date"),
        F.col("id").cast("string").alias("train_no"),
    )
    record = F.struct(F.date_format("date", "yyyy-MM-dd").alias("date"), "train_no",
                      F.lit("A").alias("origine"), F.lit("B").alias("destination"))
    raw = days.repartition(8).select(F.to_json(record).alias("json_str"))
    write_snapshot(SEEN.typed(raw), SEEN, str(tmp_path))
    assert len(list(tmp_path.rglob("*.parquet"))) <= 20
