import json
import os

from testbed import queries
from trainlake.sources import text_batch
from trainlake.streaming import refine_stream


def _files(top):
    return [os.path.join(d, f) for d, _, files in os.walk(top) for f in files if f.startswith("part-")]


def test_landed_records_are_packed_and_whole(spark, tmp_path, monkeypatch):
    """What is landed weighs a fraction of its text, in files that one task can take, and nothing is lost or torn."""
    monkeypatch.setattr(queries, "FILE_RECORDS", 1000)
    texts = [json.dumps({"train_no": f"{n:04d}", "origine": "GARE É", "note": "a\tb" * (n % 3), "n": n // 2}, ensure_ascii=False) for n in range(6000)]
    records = spark.createDataFrame([(t,) for t in texts], "json_str STRING").coalesce(1)
    waves = queries._land(records, str(tmp_path))
    found = [r.json_str for w in waves for r in text_batch(spark, w).collect()]
    assert sorted(found) == sorted(texts)
    files = _files(tmp_path / "landed")
    assert 4 * sum(map(os.path.getsize, files)) < sum(len(t.encode()) + 1 for t in texts)
    assert len(files) >= 6
    # a feed that grows
    feed = f"{tmp_path}/feed"
    for part in (records, records.limit(0), records):
        queries._landing(part).text(feed)
    assert sorted(r.json_str for r in text_batch(spark, feed).collect()) == sorted(texts * 2)


def test_state_of_first_seen_is_on_disk_and_bounded_in_memory(spark, tmp_path, monkeypatch):
    """The store a query was started with stands in its checkpoint; the session's settings are as before afterwards."""
    prefix = "spark.sql.streaming.stateStore."
    names = [f"{prefix}providerClass", f"{prefix}rocksdb.boundedMemoryUsage", f"{prefix}rocksdb.maxMemoryUsageMB", "spark.sql.shuffle.partitions"]
    before, started = [spark.conf.get(n, None) for n in names], []

    def refine(*args, **options):
        started.append([spark.conf.get(n, None) for n in names])
        return refine_stream(*args, **options)

    record = {"date": "1999-01-01", "train_no": "1", "origine": "A", "destination": "B", "ingested_at": "1"}
    texts = [json.dumps({**record, "train_no": str(n % 7), "ingested_at": str(n)}) for n in range(50)]
    landed = spark.createDataFrame([(t,) for t in texts], "json_str STRING")
    monkeypatch.setattr(queries, "scratch", lambda _: str(tmp_path))
    monkeypatch.setattr(queries, "raw", lambda *_: landed)
    monkeypatch.setattr(queries, "refine_stream", refine)
    found = queries.stream_first_seen(spark, "")
    assert sorted((r.train_no, r.n) for r in found.collect()) == [(str(n), 1) for n in range(7)]
    assert len(started) == queries.WAVES
    assert all("RocksDB" in s[0] and s[1] == "true" and 0 < int(s[2]) <= 512 for s in started)
    offsets = tmp_path / "checkpoint" / "offsets"
    assert all("RocksDBStateStoreProvider" in (offsets / f).read_text() for f in os.listdir(offsets) if f.isdigit())
    assert [spark.conf.get(n, None) for n in names] == before
