import json
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException

from trainlake.__main__ import main
from trainlake.dataset import clean
from trainlake.plans.audit import MissingData
from trainlake.plans.availability import availability
from trainlake.plans.ridership import RIDERSHIP
from trainlake.plans.stations import STATIONS
from trainlake.plans.registry import DATASETS
from trainlake.sources import read_silver, text_batch, text_source
from trainlake.streaming import AVAILABLE_NOW, refine_all, refine_stream, wait_for_all

SEEN = availability("2024-01-01")


class Feed:
    """A landing directory and a query that is restarted for every file."""

    def __init__(self, spark, tmp_path, dataset, **options):
        self.spark, self.dataset, self.options = spark, dataset, options
        self.landed, self.base = tmp_path / "landed", str(tmp_path / "silver")
        self.checkpoint = str(tmp_path / "checkpoint")
        self.landed.mkdir()
        self.batches = []
        self.files = 0

    def land(self, *records):
        lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
        (self.landed / f"{self.files}.json").write_text("\n".join(lines) + "\n")
        self.files += 1

    def run(self):
        refine_stream(
            text_source(self.spark, str(self.landed)), self.dataset, self.base, self.checkpoint,
            trigger=AVAILABLE_NOW, on_batch=lambda *b: self.batches.append(b), **self.options,
        ).awaitTermination()

    def silver(self):
        return read_silver(self.spark, self.dataset, self.base)


def ridership(**numbers):
    return [
        {"nom_gare": k, "code_uic_complet": k, "total_voyageurs_2024": v, "ingested_at": f"{v:04d}"}
        for k, v in numbers.items()
    ]


@pytest.mark.parametrize("mode", ["snapshot", "append"])
@pytest.mark.parametrize(
    "keep, wanted", [("first", {"a": 1, "b": 1, "c": 2}), ("last", {"a": 3, "b": 1, "c": 2})]
)
def test_batches_with_restarts_lose_no_key(spark, tmp_path, mode, keep, wanted):
    feed = Feed(spark, tmp_path, replace(RIDERSHIP, keep=keep), mode=mode)
    for batch in ({"a": 1, "b": 1}, {"a": 2, "c": 2}, {"a": 3}):
        feed.land(*ridership(**batch))
        feed.run()
    assert {r.code_uic: r.voyageurs_2024 for r in feed.silver().collect()} == wanted
    # The stream ends where a batch over the same files does.
    batch = clean(RIDERSHIP, text_batch(spark, str(feed.landed)), keep)
    columns = [c for c in batch.columns if c != "processed_at"]
    stream = feed.silver().select(columns)
    assert sorted(stream.collect()) == sorted(batch.select(columns).collect())
    rows = {"snapshot": [2, 3, 3], "append": [2, 2, 1]}[mode]
    assert feed.batches == [("frequentation", n, r) for n, r in enumerate(rows)]


def test_replace_mode_shows_the_last_batch_only(spark, tmp_path):
    feed = Feed(spark, tmp_path, RIDERSHIP, mode="replace")
    for batch in ({"a": 1, "b": 1}, {"c": 2}):
        feed.land(*ridership(**batch))
        feed.run()
    assert [r.code_uic for r in feed.silver().collect()] == ["c"]


@pytest.mark.parametrize("mode", ["snapshot", "append"])
def test_batches_without_good_records_write_nothing(spark, tmp_path, mode):
    feed = Feed(spark, tmp_path, STATIONS, mode=mode)
    feed.land("{", "{}", "")
    feed.run()
    assert feed.batches == [] and feed.silver().count() == 0
    assert not list((tmp_path / "silver").rglob("*.parquet"))


@pytest.mark.parametrize("mode", ["snapshot", "append"])
def test_a_lost_checkpoint_costs_nothing(spark, tmp_path, mode):
    feed = Feed(spark, tmp_path, RIDERSHIP, mode=mode)
    feed.land(*ridership(a=1, b=1))
    feed.run()
    (feed.landed / "0.json").unlink()  # the source has forgotten it
    feed.land(*ridership(a=2, c=2))
    feed.checkpoint += "-new"
    feed.run()
    found = {r.code_uic: r.voyageurs_2024 for r in feed.silver().collect()}
    assert found == {"a": 1, "b": 1, "c": 2}


def test_streams_hold_no_state_and_parse_once(spark, tmp_path):
    feed = Feed(spark, tmp_path, STATIONS)
    feed.land("{}")
    query = refine_stream(
        text_source(spark, str(feed.landed)), STATIONS, feed.base, feed.checkpoint,
        trigger=AVAILABLE_NOW,
    )
    query.awaitTermination()
    assert query.lastProgress["stateOperators"] == []
    text = query._jsq.explainInternal(False)
    assert text.count("from_json") == 1


def test_rejects_come_from_the_same_parse(spark, tmp_path):
    landed = tmp_path / "landed"
    landed.mkdir()
    good = {"codes_uic": "1", "position_geographique": {"lat": 45, "lon": 0}, "ingested_at": "1"}
    away = {"codes_uic": "2", "position_geographique": {"lat": 5, "lon": 0}}
    bad_name = {"codes_uic": "3", "nom": "X", "position_geographique": {"lat": "north", "lon": 0}}

    def run():
        query = refine_stream(
            text_source(spark, str(landed)), STATIONS, f"{tmp_path}/silver", f"{tmp_path}/checkpoint",
            trigger=AVAILABLE_NOW, rejects=f"{tmp_path}/rejects/",
        )
        query.awaitTermination()
        return query

    def state():
        stored = sorted(r.codes_uic for r in read_silver(spark, STATIONS, f"{tmp_path}/silver").collect())
        rejects = spark.read.schema("json_str STRING, reason STRING").parquet(f"{tmp_path}/rejects").collect()
        return stored, sorted((r.reason, r.json_str) for r in rejects)

    def replay(batch):
        """As after a crash between the sinks and the commit of the batch."""
        for file in (tmp_path / "checkpoint" / "commits").glob(f"*{batch}*"):
            file.unlink()
        run()

    (landed / "0.json").write_text("\n".join([json.dumps(good), json.dumps(away), "{torn"]))
    query = run()
    assert query._jsq.explainInternal(False).count("from_json") == 1
    assert sum(p["numInputRows"] for p in query.recentProgress) == 3  # the batch is read once
    first = ["1"], [("outside_country", json.dumps(away)), ("unreadable", "{torn")]
    assert state() == first
    replay(0)
    assert state() == first
    (landed / "1.json").write_text("\n".join([json.dumps(bad_name), json.dumps({**good, "codes_uic": "4"})]))
    run()
    (landed / "2.json").write_text(json.dumps({**good, "codes_uic": "5"}))
    run()
    whole = ["1", "4", "5"], sorted([*first[1], ("bad_field", json.dumps(bad_name))])
    assert state() == whole
    for _ in range(2):
        replay(2)
    assert state() == whole
    with pytest.raises(ValueError, match="exclude"):
        refine_stream(text_source(spark, str(landed)), SEEN, f"{tmp_path}/s", f"{tmp_path}/c", ttl="1 day", rejects="x")


def seat(n, stamp):
    return {"date": "2024-01-07", "train_no": str(n), "origine": "A", "destination": "B",
            "od_happy_card": "OUI", "ingested_at": f"{stamp:04d}"}


def test_copies_are_dropped_within_their_time_to_live(spark, tmp_path):
    feed = Feed(spark, tmp_path, replace(SEEN, keep="first"), mode="append", ttl="1 day")
    feed.land(*[seat(n, 0) for n in range(3)], *[seat(0, k) for k in range(200)])
    feed.run()
    feed.land(seat(0, 5), seat(3, 5))
    feed.run()
    feed.land(seat(1, 6))
    feed.run()
    assert [rows for _, _, rows in feed.batches] == [3, 1]
    assert feed.silver().count() == 4


def test_ttl_is_for_first_reports_in_append_mode(spark, tmp_path):
    feed = Feed(spark, tmp_path, SEEN, ttl="1 day")
    with pytest.raises(ValueError):
        feed.run()
    with pytest.raises(ValueError):
        Feed(spark, tmp_path / "landed", SEEN, mode="upsert").run()


def test_all_streams_at_once(spark, tmp_path):
    records = {
        "gares": {"codes_uic": "1", "position_geographique": {"lat": 45, "lon": 0}},
        "frequentation": ridership(a=1)[0],
        "tgvmax": {**seat(1, 1), "date": "2999-01-01"},
        "regularite": {"date": "2024-03", "gare_depart": "A", "nb_train_prevu": 10},
    }
    for name, record in records.items():
        (tmp_path / "landed" / name).mkdir(parents=True)
        (tmp_path / "landed" / name / "0.json").write_text(json.dumps(record) + "\n{torn")
    main(["refine", "--landed", f"{tmp_path}/landed", "--silver", f"{tmp_path}/silver",
          "--checkpoints", f"{tmp_path}/checkpoints", "--rejects", f"{tmp_path}/rejects"])
    for name in records:
        rejects = spark.read.parquet(f"{tmp_path}/rejects/{name}").collect()
        assert [(r.json_str, r.reason) for r in rejects] == [("{torn", "unreadable")]
    main(["audit", "--silver", f"{tmp_path}/silver"])
    main(["compact", "--silver", f"{tmp_path}/silver", "--dataset", "tgvmax"])
    for name, dataset in DATASETS.items():
        assert read_silver(spark, dataset, f"{tmp_path}/silver").count() == 1, name
    assert (tmp_path / "silver/tgvmax/v=00000000/date_depart=2999-01-01").is_dir()


def test_one_failing_stream_stops_the_others(spark, tmp_path):
    for name in ("gares", "frequentation"):
        (tmp_path / name).mkdir()
    (tmp_path / "frequentation" / "0.json").write_text(json.dumps(ridership(a=1)[0]))

    def broken(*_):
        raise RuntimeError("sink is gone")

    sources = {n: text_source(spark, f"{tmp_path}/{n}") for n in ("gares", "frequentation")}
    queries = refine_all(
        sources, f"{tmp_path}/silver", f"{tmp_path}/checkpoints", trigger="1 second",
        on_batch=broken,
    )
    with pytest.raises(StreamingQueryException, match="sink is gone"):
        wait_for_all(queries)
    assert not any(q.isActive for q in queries)


def test_extract_job(spark, tmp_path):
    pages = {
        "gares": [{"codes_uic": "1", "uic_extra": {"a": [1, None]}, "position_geographique": {"lat": 45, "lon": 0}},
                  {"codes_uic": "2", "position_geographique": {"lat": 50, "lon": 0}}],
        "frequentation": [{"code_uic_complet": "1"}, {"code_uic_complet": "2"}],
        "tgvmax": [{"axe": "ATLANTIQUE", "date": "2024-02-01"}],
        "regularite": [{"gare_depart": "BORDEAUX"}, {"gare_depart": "PARIS"}],
    }
    for name, results in pages.items():
        (tmp_path / "pages" / name).mkdir(parents=True)
        body = {"total_count": len(results), "results": results}
        (tmp_path / "pages" / name / "0.json").write_text(json.dumps(body))
    main(["extract", "--pages", f"{tmp_path}/pages", "--out", f"{tmp_path}/out",
          "--as-of", "2024-01-01"])
    for name in pages:
        (line,) = text_batch(spark, f"{tmp_path}/out/{name}").collect()
        record = json.loads(line.json_str)
        assert record.pop("ingested_at") and record == pages[name][0]


def test_extract_cuts_nothing_and_stops_on_gaps(spark, tmp_path):
    trains = [{"axe": "ATLANTIQUE", "date": "2024-02-01", "train_no": str(n)} for n in range(6000)]
    pages = {"gares": [], "frequentation": [], "tgvmax": trains, "regularite": []}
    for name, results in pages.items():
        (tmp_path / "pages" / name).mkdir(parents=True)
        (tmp_path / "pages" / name / "0.json").write_text(json.dumps({"total_count": len(results), "results": results}))
    argv = ["extract", "--pages", f"{tmp_path}/pages", "--as-of", "2024-01-01", "--rejects", f"{tmp_path}/rejects"]
    main([*argv, "--out", f"{tmp_path}/out"])
    assert text_batch(spark, f"{tmp_path}/out/tgvmax").count() == 6000
    (tmp_path / "pages" / "tgvmax" / "1.json").write_text('{"total_count": 6000, "resul')
    with pytest.raises(MissingData, match="1 torn"):
        main([*argv, "--out", f"{tmp_path}/again"])
    main([*argv, "--out", f"{tmp_path}/again", "--incomplete"])
    assert text_batch(spark, f"{tmp_path}/again/tgvmax").count() == 6000


def test_a_backlog_comes_in_several_batches(spark, tmp_path):
    feed = Feed(spark, tmp_path, RIDERSHIP)
    for n in range(3):
        feed.land(*ridership(**{f"k{n}": n}))
    refine_stream(
        text_source(spark, str(feed.landed), maxFilesPerTrigger="1"), RIDERSHIP, feed.base, feed.checkpoint,
        trigger=AVAILABLE_NOW, on_batch=lambda *b: feed.batches.append(b),
    ).awaitTermination()
    assert len(feed.batches) == 3 and feed.silver().count() == 3


@pytest.mark.parametrize(
    "argv",
    [
        ["refine", "--silver", "s", "--checkpoints", "c"],
        ["refine", "--silver", "s", "--checkpoints", "c", "--servers", "h:1"],
        ["refine", "--silver", "s", "--checkpoints", "c", "--landed", "l", "--mode", "replace", "--option", "maxFilesPerTrigger=1"],
        ["extract", "--pages", "p", "--servers", "h:1", "--topics", "a=b", "--out", "o"],
    ],
)
def test_job_arguments_are_checked(argv):
    with pytest.raises(SystemExit):
        main(argv)
