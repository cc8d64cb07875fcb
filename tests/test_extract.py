import json

import pytest
from pyspark.sql import functions as F

from trainlake import schemas
from trainlake.operators import parse_json
from trainlake.plans import extract, page_completeness
from trainlake.plans.audit import missing_datasets
from trainlake.sinks import kafka_messages, object_store_conf
from trainlake.sinks import text_messages
from trainlake.sources import unreadable_pages
from trainlake.sources import declared_totals, kafka_source, read_pages, read_static


@pytest.fixture
def stations(raw):
    def make(*positions):
        records = [
            {"codes_uic": str(i), "position_geographique": p and {"lat": p[0], "lon": p[1]}}
            for i, p in enumerate(positions)
        ]
        return parse_json(raw(*records), schemas.STATIONS_WIRE)

    return make


def test_regional_box(stations):
    df = stations((43, -2), (47, 2.5), (45.0, 0.0), (47.01, 0), (45, 2.51), None)
    assert {r.codes_uic for r in extract.regional_stations(df).collect()} == {"0", "1", "2"}


def test_ridership_of_stations(spark, stations, plan):
    records = spark.createDataFrame(
        [("0", 1), ("0", 2), ("1", 3), ("9", 4), (None, 5)], "code_uic_complet STRING, n INT"
    )
    local = stations((45, 0), (45, 1), (45, 2)).union(stations((45, 0)))
    found = extract.ridership_of(records, local)
    assert sorted(r.n for r in found.collect()) == [1, 2, 3]
    assert found.columns == records.columns
    assert "LeftSemi" in plan(found) and "NestedLoop" not in plan(found)


def test_upcoming_on_axes(spark):
    rows = [("ATLANTIQUE", f"2024-01-{d:02d}") for d in range(1, 31)] + [("NORD", "2024-01-30")]
    df = spark.createDataFrame(rows, "axe STRING, date STRING").withColumns(
        {c: F.lit("x") for c in ("train_no", "origine", "destination", "ingested_at")}
    )
    found = extract.upcoming_on_axes(df, as_of="2024-01-10").orderBy("date").limit(5).collect()
    assert [r.date for r in found] == [f"2024-01-{d}" for d in range(10, 15)]
    assert extract.upcoming_on_axes(df, as_of="2024-01-10").count() == 21
    both = extract.upcoming_on_axes(df, ("ATLANTIQUE", "NORD"), "2024-01-10")
    assert both.count() == 22
    assert extract.upcoming_on_axes(df).count() == 0


def test_punctuality_from(spark):
    df = spark.createDataFrame([("BORDEAUX ST JEAN",), ("GARE DE BORDEAUX",), ("PARIS",), (None,)],
                               "gare_depart STRING")
    assert extract.punctuality_from(df).count() == 2


def test_regional_extract(raw, stations):
    parts = [
        parse_json(raw(r), w)
        for r, w in [
            ({"code_uic_complet": "0"}, schemas.RIDERSHIP_WIRE),
            ({"axe": "ATLANTIQUE", "date": "2024-01-10"}, schemas.AVAILABILITY_WIRE),
            ({"gare_depart": "BORDEAUX"}, schemas.PUNCTUALITY_WIRE),
        ]
    ]
    cut = extract.regional_extract(stations((45, 0), (50, 0)), *parts, as_of="2024-01-01")
    assert {n: df.count() for n, df in cut.items()} == dict.fromkeys(extract.MESSAGE_KEYS, 1)


# -- messages ---------------------------------------------------------------


def test_messages(spark):
    df = spark.createDataFrame(
        [("87", "Angoulême", None), (None, "x", 1), ("", "y", 2)], "code STRING, nom STRING, n INT"
    )
    found = {json.loads(r.value)["nom"]: r for r in kafka_messages(df, ["code"]).collect()}
    assert found["Angoulême"].key == "87" and "Angoulême" in found["Angoulême"].value
    assert found["x"].key is None and found["y"].key is None
    record = json.loads(found["Angoulême"].value)
    assert record["n"] is None
    assert len(record["ingested_at"]) == 20 and record["ingested_at"].endswith("Z")


def test_messages_without_key(spark):
    assert kafka_messages(spark.range(1)).first().key is None


def test_messages_replace_an_old_stamp(spark):
    df = spark.createDataFrame([("a", "old")], "x STRING, ingested_at STRING")
    value = kafka_messages(df).first().value
    assert value.count("ingested_at") == 1 and "old" not in value


class Recorder:
    """Stands in for a session: notes what the reader is told."""

    def __init__(self, df):
        self.df, self.options_seen = df, {}
        self.readStream = self

    def format(self, name):
        self.options_seen["format"] = name
        return self

    def option(self, name, value):
        self.options_seen[name] = value
        return self

    def options(self, **more):
        self.options_seen.update(more)
        return self

    def load(self):
        return self.df


def test_kafka_source_options_and_payload(spark):
    """No broker and no connector here: only the options and the decoding are checked."""
    payload = spark.createDataFrame([(b"k", b'{"a":1}')], "key BINARY, value BINARY")
    recorder = Recorder(payload)
    df = kafka_source(recorder, "host:9092", "stations", minPartitions="64")
    assert df.collect() == [('{"a":1}',)] and df.columns == ["json_str"]
    assert recorder.options_seen == {
        "format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "stations",
        "startingOffsets": "earliest", "failOnDataLoss": "false", "minPartitions": "64",
    }


def test_object_store_conf_has_no_default_secrets():
    conf = object_store_conf("http://store:9000")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert not [k for k in conf if "key" in k]
    assert "spark.hadoop.fs.s3a.secret.key" in object_store_conf("x", "a", "b")


# -- pages and static tables ------------------------------------------------


@pytest.fixture
def pages(tmp_path):
    def land(total, *results):
        for i, page in enumerate(results):
            body = {"total_count": total, "results": page}
            (tmp_path / f"page-{i}.json").write_text(json.dumps(body, indent=1))
        return str(tmp_path)

    return land


def test_read_pages(spark, pages):
    path = pages(3, [{"a": 1, "deep": {"b": [1]}}, {"a": 2}], [{"a": 3}], [])
    found = [json.loads(r.json_str) for r in read_pages(spark, path).collect()]
    assert sorted(found, key=lambda r: r["a"]) == [{"a": 1, "deep": {"b": [1]}}, {"a": 2}, {"a": 3}]
    assert declared_totals(spark, path).drop("pull").collect() == [(3, 3, 0)]
    assert page_completeness(spark, path).first().complete is True


def test_incomplete_pages(spark, pages):
    assert page_completeness(spark, pages(250, [{"a": 1}])).drop("pull").collect() == [(250, 1, 0, False)]


def test_copies_of_half_a_pull_are_not_a_whole_one(spark, pages):
    path = pages(2, [{"a": 1}], [{"a": 1}])
    assert page_completeness(spark, path).drop("pull").collect() == [(2, 1, 0, False)]


def test_torn_pages_are_told(spark, pages, tmp_path):
    path = pages(1, [{"a": 1}])
    (tmp_path / "torn.json").write_text('{"total_count": 1, "results": [{"a"')
    assert [json.loads(r.json_str) for r in read_pages(spark, path).collect()] == [{"a": 1}]
    (torn,) = unreadable_pages(spark, path).collect()
    assert torn.file.endswith("torn.json") and torn.page.startswith("{")
    assert page_completeness(spark, path).first().complete is False


def test_pulls_are_judged_each(spark, tmp_path):
    for pull, total in (("a", 1), ("b", 2)):
        (tmp_path / pull).mkdir()
        (tmp_path / pull / "0.json").write_text(json.dumps({"total_count": total, "results": [{"a": 1}]}))
    found = page_completeness(spark, f"{tmp_path}/*").collect()
    assert {r.pull[-1]: r.complete for r in found} == {"a": True, "b": False}


def test_records_travel_whole(spark, raw):
    at = F.lit("2024-01-07 08:00:00").cast("timestamp")
    given = {"codes_uic": "1", "n": 1.50, "big": 12345678901, "deep": {"b": [1, None]}, "nom": "Angoulême", "ingested_at": "old"}
    (sent,) = text_messages(raw(given).withColumn("codes_uic", F.lit("1")), ["codes_uic"], at).collect()
    assert sent.key == "1"
    assert json.loads(sent.value) == {**given, "ingested_at": "2024-01-07T08:00:00Z"}


def test_pages_one_per_line(spark, tmp_path):
    lines = [json.dumps({"total_count": 2, "results": [{"a": i}]}) for i in range(2)]
    (tmp_path / "pages.jsonl").write_text("\n".join(lines))
    assert read_pages(spark, str(tmp_path), multi_line=False).count() == 2
    assert page_completeness(spark, str(tmp_path), multi_line=False).first().complete is True


def test_read_static(spark, tmp_path):
    (tmp_path / "poi.csv").write_text("poi_id,name,kind,plat,plon\n1,Musée,musee,44.8,-0.5\n")
    df = read_static(spark, str(tmp_path), schemas.POINTS)
    assert df.collect() == [(1, "Musée", "musee", 44.8, -0.5)]
    factors = spark.createDataFrame([("train", 2.5)], schemas.EMISSION_FACTORS)
    factors.write.parquet(str(tmp_path / "factors"))
    again = read_static(spark, str(tmp_path / "factors"), schemas.EMISSION_FACTORS, "parquet")
    assert again.collect() == [("train", 2.5)]


def test_missing_datasets(spark):
    expected = spark.createDataFrame([("a",), ("b",), ("b",)], "dataset STRING")
    present = spark.createDataFrame([("a",), ("c",)], "dataset STRING")
    assert missing_datasets(expected, present).collect() == [("b",)]
