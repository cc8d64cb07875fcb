"""The registered queries: every operator over whole tables."""

from contextlib import ExitStack, contextmanager
from functools import reduce

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from testbed.views import AS_OF, raw, rows, wire
from trainlake import schemas
from trainlake.dataset import quarantine
from trainlake.functions import (
    co2_saved_kg,
    geo_cell,
    grid_degree,
    in_box,
    ingest_stamp,
    is_weekend,
    month_text,
    not_negative,
    od_pair,
    parse_day,
    pct_change,
    title_case,
    weekday_index,
    whole_number,
    year_text,
)
from trainlake.operators import distinct_records, keep_one, parse_json, require, route_segments, within_km
from trainlake.plans import (
    audit,
    clean_availability,
    clean_punctuality,
    clean_ridership,
    clean_stations,
    extract,
    questions,
)
from trainlake.functions.carbon import CAR_G_PER_KM, TRAIN_G_PER_KM
from trainlake.plans.availability import availability
from trainlake.plans.punctuality import PUNCTUALITY
from trainlake.plans.registry import DATASETS
from trainlake.plans.ridership import RIDERSHIP
from trainlake.plans.stations import STATIONS
from trainlake.sinks import append_lot, compact, kafka_messages, text_messages, write_snapshot
from trainlake.shared import scratch
from trainlake.sources import read_pages, read_silver, read_static, text_source
from trainlake.streaming import AVAILABLE_NOW, refine_all, refine_stream, wait_for_all
from trainlake.streaming.state import ROCKSDB_CONF, remembered_keys

RADIUS_KM = 10.0


def _silver(df: DataFrame) -> DataFrame:
    """Without the time stamp of the run, which no two engines share."""
    return df.drop("processed_at")


# -- cleaned tables ---------------------------------------------------------


def stations(spark, sf_dir):
    return _silver(clean_stations(raw(spark, sf_dir, "stations")))


def ridership(spark, sf_dir):
    return _silver(clean_ridership(raw(spark, sf_dir, "ridership")))


def availability_seen(spark, sf_dir, **options):
    return _silver(clean_availability(raw(spark, sf_dir, "availability"), AS_OF, **options))


def availability_latest(spark, sf_dir):
    return availability_seen(spark, sf_dir, keep="last")


def availability_legacy_weekday(spark, sf_dir):
    return availability_seen(spark, sf_dir, legacy_weekday=True)


def punctuality(spark, sf_dir):
    return _silver(clean_punctuality(raw(spark, sf_dir, "punctuality")))


def punctuality_validated_first(spark, sf_dir):
    return _silver(clean_punctuality(raw(spark, sf_dir, "punctuality"), validate_first=True))


# -- parsing and messages ---------------------------------------------------


def props_json_parse(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return parse_json(events, "k BIGINT", "event_id", column="props")


def json_roundtrip(spark, sf_dir):
    records = parse_json(raw(spark, sf_dir, "ridership"), schemas.RIDERSHIP_WIRE)
    sent = kafka_messages(records).select(F.col("value").alias("json_str"))
    return parse_json(sent, schemas.RIDERSHIP_WIRE).drop("ingested_at")


def _keys(spark, sf_dir, view, name):
    messages = kafka_messages(wire(spark, sf_dir, view), extract.MESSAGE_KEYS[name])
    return messages.groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def message_keys(spark, sf_dir):
    return _keys(spark, sf_dir, "stations", "gares")


def message_keys_composite(spark, sf_dir):
    return _keys(spark, sf_dir, "availability", "tgvmax")


def page_records(spark, sf_dir):
    """Ridership landed as API pages of two copies each, one per line, and read back."""
    landed = scratch(spark)
    records = wire(spark, sf_dir, "ridership")
    record = F.struct("*")
    page = F.struct(F.lit(2).alias("total_count"), F.array(record, record).alias("results"))
    records.select(F.to_json(page).alias("value")).write.text(landed)
    return parse_json(read_pages(spark, landed, multi_line=False), schemas.RIDERSHIP_WIRE)


# -- filters ----------------------------------------------------------------


def required_fields_filter(spark, sf_dir):
    return require(rows(spark, sf_dir, "stations"), "codes_uic", "lat", "lon")


def country_box(spark, sf_dir):
    inside = in_box(F.col("lat"), F.col("lon"), schemas.COUNTRY_LAT, schemas.COUNTRY_LON)
    return rows(spark, sf_dir, "stations").where(inside)


def regional_box(spark, sf_dir):
    local = extract.regional_stations(wire(spark, sf_dir, "stations"))
    return local.select("nom", "codes_uic", "position_geographique.lat", "position_geographique.lon")


def future_dates(spark, sf_dir):
    rows_ = availability(AS_OF).typed(raw(spark, sf_dir, "availability"))
    return rows_.select("date_depart", "train_no", "ingested_at")


def axis_date_filter(spark, sf_dir):
    return extract.upcoming_on_axes(rows(spark, sf_dir, "availability"), as_of=AS_OF)


def axes_date_filter(spark, sf_dir):
    return extract.upcoming_on_axes(
        rows(spark, sf_dir, "availability"), ("ATLANTIQUE", "NORD"), AS_OF
    )


def substring_filter(spark, sf_dir):
    return extract.punctuality_from(rows(spark, sf_dir, "punctuality")).select(
        "date", "gare_depart", "gare_arrivee", "nb_train_prevu"
    )


# -- joins ------------------------------------------------------------------


def ridership_semi_join(spark, sf_dir):
    local = extract.regional_stations(wire(spark, sf_dir, "stations"))
    return extract.ridership_of(rows(spark, sf_dir, "ridership"), local)


def stations_with_ridership(spark, sf_dir):
    return questions.stations_with_ridership(
        stations(spark, sf_dir), ridership(spark, sf_dir)
    ).select("codes_uic", "nom_gare", "voyageurs_2024", "voyageurs_2019", "evolution_pct_2019_2024")


def station_point_pairs(spark, sf_dir):
    pairs = within_km(stations(spark, sf_dir), rows(spark, sf_dir, "points"), RADIUS_KM)
    return pairs.select("codes_uic", "poi_id", F.round("distance_km", 3).alias("distance_km"))


def station_cycle_pairs(spark, sf_dir):
    pairs = within_km(stations(spark, sf_dir), rows(spark, sf_dir, "cycle_points"), RADIUS_KM)
    return pairs.select("codes_uic", "poi_id", F.round("distance_km", 3).alias("distance_km"))


def missing_datasets(spark, sf_dir):
    """Stations of the availability feed that the station table does not name."""
    used = rows(spark, sf_dir, "availability").select(F.col("origine").alias("nom_gare"))
    return audit.missing_datasets(used, rows(spark, sf_dir, "named_stations"), on="nom_gare")


# -- dedup ------------------------------------------------------------------


def _one_per_customer(spark, sf_dir, keep):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return keep_one(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], keep)


def keep_first(spark, sf_dir):
    return _one_per_customer(spark, sf_dir, "first")


def keep_last(spark, sf_dir):
    return _one_per_customer(spark, sf_dir, "last")


def keep_first_null_key(spark, sf_dir):
    """NULL arrival stations are one group, not many."""
    typed = PUNCTUALITY.typed(raw(spark, sf_dir, "punctuality"))
    kept = PUNCTUALITY.keep_one(typed)
    return kept.groupBy("gare_arrivee").agg(F.count(F.lit(1)).alias("n"))


def distinct_rows(spark, sf_dir):
    """Whole rows, of a feed in which each comes twice."""
    feed = rows(spark, sf_dir, "availability")
    return distinct_records(feed.unionByName(feed))


# -- derived columns --------------------------------------------------------


def clamp_and_change(spark, sf_dir):
    v24, v19 = (
        not_negative(whole_number(F.col(f"total_voyageurs_{y}"))) for y in (2024, 2019)
    )
    return rows(spark, sf_dir, "ridership").select(
        "code_uic_complet", "ingested_at", v24.alias("v24"), v19.alias("v19"),
        pct_change(v24, v19).alias("change_pct"),
    )


def rates_validated(spark, sf_dir):
    typed = PUNCTUALITY.typed(raw(spark, sf_dir, "punctuality"))
    rated = PUNCTUALITY.check(PUNCTUALITY.derive(typed))
    return rated.select(
        "periode", "gare_depart", "gare_arrivee", "ingested_at", "nb_train_prevu",
        "taux_regularite_pct", "taux_annulation_pct",
    )


def calendar_features(spark, sf_dir):
    text = F.col("date")
    day = parse_day(text)
    return rows(spark, sf_dir, "availability").select(
        "ingested_at", day.alias("day"), weekday_index(day).alias("weekday"),
        is_weekend(day).alias("weekend"), year_text(text).alias("year"),
        month_text(text).alias("month"),
    )


def text_features(spark, sf_dir):
    return rows(spark, sf_dir, "availability").select(
        "ingested_at", od_pair(F.col("origine"), F.col("destination")).alias("od"),
        title_case(F.col("axe")).alias("axis_name"), co2_saved_kg().alias("co2_kg"),
    )


def geo_cells(spark, sf_dir):
    lat, lon = F.col("lat"), F.col("lon")
    return require(rows(spark, sf_dir, "stations"), "lat", "lon").select(
        "nom", grid_degree(lat).alias("lat_grid"), grid_degree(lon).alias("lon_grid"),
        geo_cell(lat, lon).alias("cell"),
    )


# -- questions --------------------------------------------------------------


def poi_within_10km(spark, sf_dir):
    return questions.stations_near_points(
        stations(spark, sf_dir), rows(spark, sf_dir, "points"), RADIUS_KM
    )


def station_nearest_point(spark, sf_dir):
    return questions.nearest_points(stations(spark, sf_dir), rows(spark, sf_dir, "points"))


def _segments(spark, sf_dir):
    return route_segments(rows(spark, sf_dir, "cycle_routes"), ["route"], ["plon", "poi_id"])


def station_routes(spark, sf_dir):
    """Stations near a cycle route, though perhaps near none of its points."""
    return questions.stations_near_routes(stations(spark, sf_dir), _segments(spark, sf_dir), RADIUS_KM)


def bike_reach_by_route(spark, sf_dir):
    return questions.bike_reach_by_route(
        stations(spark, sf_dir), _segments(spark, sf_dir), rows(spark, sf_dir, "points"), RADIUS_KM, 2 * RADIUS_KM
    )


def weekend_seats_by_od(spark, sf_dir):
    return questions.weekend_seats(availability_seen(spark, sf_dir), AS_OF)


def co2_by_od(spark, sf_dir):
    """Over the cleaned stations, with the factors of a static table."""
    path = scratch(spark)
    factors = spark.createDataFrame([("car", CAR_G_PER_KM), ("train", TRAIN_G_PER_KM)], schemas.EMISSION_FACTORS)
    factors.write.option("header", "true").csv(path)
    car, train = questions.emission_factors(read_static(spark, path, schemas.EMISSION_FACTORS))
    named = clean_stations(raw(spark, sf_dir, "gare_stations"))
    return questions.co2_by_connection(availability_seen(spark, sf_dir), named, car, train)


def bike_reach(spark, sf_dir):
    return questions.bike_reach(
        stations(spark, sf_dir), rows(spark, sf_dir, "cycle_points"),
        rows(spark, sf_dir, "points"), RADIUS_KM, 2 * RADIUS_KM,
    )


def punctuality_trend(spark, sf_dir):
    return questions.punctuality_trend(punctuality(spark, sf_dir))


# -- quarantine -------------------------------------------------------------


def quarantine_stations(spark, sf_dir):
    found = quarantine(STATIONS, raw(spark, sf_dir, "stations"))
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def quarantine_torn_records(spark, sf_dir):
    """Every ridership record, cut short in the middle of its text."""
    torn = raw(spark, sf_dir, "ridership").select(
        F.expr("substr(json_str, 1, length(json_str) div 2)").alias("json_str")
    )
    found = quarantine(RIDERSHIP, torn)
    return found.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# -- landing ----------------------------------------------------------------


def ingest_stamps(spark, sf_dir):
    """Event times as the stamps of messages."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select("event_id", ingest_stamp(F.col("ts")).alias("ingested_at"))


def _whole_records(spark, sf_dir):
    """Availability records with fields that no schema names."""
    record = rows(spark, sf_dir, "availability").select(F.struct("*", F.length("axe").alias("n_axe"), F.array("axe").alias("axes")).alias("r"))
    return record.select(F.to_json("r").alias("json_str"))


def regional_extract_records(spark, sf_dir):
    """The region's availability messages; what the schema doesn't name travels with them."""
    raws = {
        "gares": raw(spark, sf_dir, "stations"), "frequentation": raw(spark, sf_dir, "ridership"),
        "tgvmax": _whole_records(spark, sf_dir), "regularite": raw(spark, sf_dir, "punctuality"),
    }
    found = extract.regional_records(raws, AS_OF, axes=("ATLANTIQUE", "NORD"))["tgvmax"]
    sent = text_messages(found, extract.MESSAGE_KEYS["tgvmax"], F.lit("1998-07-01 12:00:00").cast("timestamp"))
    fields = "date STRING, train_no STRING, origine STRING, destination STRING, n_axe BIGINT, axes ARRAY<STRING>, ingested_at STRING"
    return parse_json(sent.select("key", F.col("value").alias("json_str")), fields, "key").withColumn("axes", F.array_join("axes", ","))


def regional_extract_counts(spark, sf_dir):
    """Records of the region by dataset."""
    views = {"gares": "stations", "frequentation": "ridership", "tgvmax": "availability", "regularite": "punctuality"}
    found = extract.regional_records({n: raw(spark, sf_dir, v) for n, v in views.items()}, AS_OF)
    named = [df.select(F.lit(n).alias("dataset")) for n, df in found.items()]
    return reduce(DataFrame.unionByName, named).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))


def page_completeness(spark, sf_dir):
    """Ridership landed in pulls by postcode digit; one pull of two got half of its pages, twice."""
    landed = scratch(spark)
    records = wire(spark, sf_dir, "ridership").withColumn("pull", F.substring("code_uic_complet", -1, 1))
    n = records.groupBy("pull").agg(F.count(F.lit(1)).alias("total_count"))
    record = F.struct(*[c for c in records.columns if c != "pull"])
    pages = records.join(n, "pull").select("pull", F.to_json(F.struct("total_count", F.array(record).alias("results"))).alias("value"), "ingested_at")
    half = (F.col("pull").cast("int") % 2 == 1) & (F.col("ingested_at") > "2024-01-01T12")
    kept = pages.where(~half).select("pull", "value")
    kept.unionByName(kept.where("pull % 2 = 1")).write.partitionBy("pull").text(landed)
    found = audit.page_completeness(spark, f"{landed}/*", multi_line=False)
    return found.withColumn("pull", F.substring("pull", -1, 1))


def static_points(spark, sf_dir):
    """Points of interest from a CSV table with a declared schema."""
    path = scratch(spark)
    rows(spark, sf_dir, "points").write.option("header", "true").csv(path)
    return read_static(spark, path, schemas.POINTS)


# -- tables and streams -----------------------------------------------------

WAVES = 3
STATE_PARTS = 8


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def _state_settings(spark: SparkSession):
    """State on the executors' disks: it grows with the keys, up to ``spread`` entries each, whatever the heap.

    It is partitioned once and for all at the first start, so the number is stated.
    """
    with ExitStack() as stack:
        for name, value in {**ROCKSDB_CONF, "spark.sql.shuffle.partitions": str(STATE_PARTS)}.items():
            stack.enter_context(_setting(spark, name, value))
        yield


#: Compressed text can't be split, so a landed file holds at most so many records (some 50 MB of them).
FILE_RECORDS = 200_000


def _landing(records: DataFrame) -> DataFrameWriter:
    """A writer of raw records as text, compressed: what is landed weighs more than all that follows."""
    return records.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS)


def _land(records: DataFrame, base: str) -> list[str]:
    """Raw records as text files that arrive in waves, split by content hash."""
    wave = F.pmod(F.xxhash64("json_str"), F.lit(WAVES)).cast("int")
    _landing(records.withColumn("wave", wave)).partitionBy("wave").text(f"{base}/landed")
    return [f"{base}/landed/wave={n}" for n in range(WAVES)]


def _stream(spark, sf_dir, view, dataset, **options):
    """All waves through one restarted query; returns the table's base path."""
    base = scratch(spark)
    for n, _ in enumerate(_land(raw(spark, sf_dir, view), base)):
        # The glob grows by a wave per run: a restart finds only what is new.
        source = text_source(spark, f"{base}/landed/wave=[0-{n}]")
        query = refine_stream(
            source, dataset, f"{base}/silver", f"{base}/checkpoint", trigger=AVAILABLE_NOW,
            **options,
        )
        query.awaitTermination()
    return f"{base}/silver"


def stream_snapshot(spark, sf_dir):
    base = _stream(spark, sf_dir, "stations", STATIONS)
    return _silver(read_silver(spark, STATIONS, base))


def stream_snapshot_checked(spark, sf_dir):
    base = _stream(spark, sf_dir, "punctuality", PUNCTUALITY)
    return _silver(read_silver(spark, PUNCTUALITY, base))


def stream_append(spark, sf_dir):
    seen = availability(AS_OF)
    base = _stream(spark, sf_dir, "availability", seen)
    return _silver(read_silver(spark, seen, base))


def stream_first_seen(spark, sf_dir):
    """Keys that a stream with time-limited dedup lets through, with their count."""
    seen = availability(AS_OF, keep="first")
    with _state_settings(spark):
        base = _stream(spark, sf_dir, "availability", seen, mode="append", ttl="2 days")
    lots = spark.read.schema(seen.silver).parquet(f"{base}/{seen.name}")
    return lots.groupBy(*seen.key).agg(F.count(F.lit(1)).alias("n"))


def stream_state(spark, sf_dir):
    """The keys that a finished stream with time-limited dedup remembers on disk, with the parts they are in."""
    seen = availability(AS_OF, keep="first")
    with _state_settings(spark):
        silver = _stream(spark, sf_dir, "availability", seen, mode="append", ttl="2 days")
        keys = remembered_keys(spark, silver.removesuffix("silver") + "checkpoint", seen.key)
        right_part = F.col("partition_id").between(0, STATE_PARTS - 1) & (F.col("expires_at") > F.current_timestamp())
        return keys.select(*seen.key, right_part.alias("held"))


def refined_tables(spark, sf_dir):
    """All four feeds refined at once, an empty batch after them; rows of each table, and what the audit says."""
    base = scratch(spark)
    views = {"gares": "stations", "frequentation": "ridership", "tgvmax": "availability", "regularite": "punctuality"}
    datasets = {**DATASETS, "tgvmax": availability(AS_OF)}
    counted = []
    for wave in range(2):
        for name, view in views.items():
            records = raw(spark, sf_dir, view)
            _landing(records if wave == 0 else records.limit(0)).text(f"{base}/landed/{name}")
        sources = {n: text_source(spark, f"{base}/landed/{n}") for n in views}
        wait_for_all(refine_all(
            sources, f"{base}/silver", f"{base}/checkpoints", datasets, AVAILABLE_NOW,
            on_batch=lambda name, _, n: counted.append((name, n)),
        ))
    written = spark.createDataFrame(counted, "dataset STRING, written LONG")
    there = [
        read_silver(spark, d, f"{base}/silver").select(F.lit(n).alias("dataset"))
        for n, d in datasets.items()
    ]
    present = reduce(DataFrame.unionByName, there).groupBy("dataset").agg(F.count(F.lit(1)).alias("n"))
    return present.join(written, "dataset")


def audited_tables(spark, sf_dir):
    """The feeds refined on a day after the last departure: the audit names the tables that stayed empty."""
    base = scratch(spark)
    views = {"gares": "stations", "frequentation": "ridership", "tgvmax": "availability", "regularite": "punctuality"}
    datasets = {**DATASETS, "tgvmax": availability("2999-01-01")}
    for name, view in views.items():
        write_snapshot(datasets[name].typed(raw(spark, sf_dir, view)), datasets[name], f"{base}/silver")
    return audit.missing_silver(spark, f"{base}/silver", datasets)


def stream_rejects(spark, sf_dir):
    """Defective station records by reason, from the same stream as the table."""
    base = scratch(spark)
    for n, _ in enumerate(_land(raw(spark, sf_dir, "stations"), base)):
        source = text_source(spark, f"{base}/landed/wave=[0-{n}]")
        refine_stream(
            source, STATIONS, f"{base}/silver", f"{base}/checkpoint", trigger=AVAILABLE_NOW, rejects=f"{base}/rejects"
        ).awaitTermination()
    kept = read_silver(spark, STATIONS, f"{base}/silver").select(F.lit("stored").alias("reason"))
    found = spark.read.schema("json_str STRING, reason STRING").parquet(f"{base}/rejects").select("reason")
    return found.unionByName(kept).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def lots_compacted(spark, sf_dir):
    """Two lots folded into a partitioned snapshot, a third still on its own."""
    typed = PUNCTUALITY.typed(raw(spark, sf_dir, "punctuality"))
    base = scratch(spark)
    part = F.pmod(F.xxhash64(*PUNCTUALITY.key, "ingested_at"), F.lit(3))
    for n in range(3):
        append_lot(typed.where(part == n), PUNCTUALITY, base, f"part-{n}")
        if n == 1:
            compact(spark, PUNCTUALITY, base, drop_lots=True)
    return _silver(read_silver(spark, PUNCTUALITY, base))


def snapshot_partition_read(spark, sf_dir):
    """Batch refine to a partitioned table, then one month read back."""
    base = scratch(spark)
    typed = PUNCTUALITY.typed(raw(spark, sf_dir, "punctuality"))
    write_snapshot(typed, PUNCTUALITY, base, merge=False)
    return _silver(read_silver(spark, PUNCTUALITY, base)).where("periode = '1998-07'")


QUERIES = {
    "clean_stations": stations,
    "clean_ridership": ridership,
    "clean_availability": availability_seen,
    "clean_availability_latest": availability_latest,
    "clean_punctuality": punctuality,
    "clean_punctuality_validated_first": punctuality_validated_first,
    "legacy_weekday": availability_legacy_weekday,
    "props_json_parse": props_json_parse,
    "json_roundtrip": json_roundtrip,
    "message_keys": message_keys,
    "message_keys_composite": message_keys_composite,
    "page_records": page_records,
    "required_fields_filter": required_fields_filter,
    "country_box": country_box,
    "regional_box": regional_box,
    "future_dates": future_dates,
    "axis_date_filter": axis_date_filter,
    "axes_date_filter": axes_date_filter,
    "substring_filter": substring_filter,
    "ridership_semi_join": ridership_semi_join,
    "stations_with_ridership": stations_with_ridership,
    "station_point_pairs": station_point_pairs,
    "station_cycle_pairs": station_cycle_pairs,
    "missing_datasets": missing_datasets,
    "keep_first": keep_first,
    "keep_last": keep_last,
    "keep_first_null_key": keep_first_null_key,
    "distinct_rows": distinct_rows,
    "clamp_and_change": clamp_and_change,
    "rates_validated": rates_validated,
    "calendar_features": calendar_features,
    "text_features": text_features,
    "geo_cell": geo_cells,
    "poi_within_10km": poi_within_10km,
    "station_nearest_point": station_nearest_point,
    "station_routes": station_routes,
    "bike_reach_by_route": bike_reach_by_route,
    "weekend_seats_by_od": weekend_seats_by_od,
    "co2_by_od": co2_by_od,
    "bike_reach": bike_reach,
    "punctuality_trend": punctuality_trend,
    "quarantine_reasons": quarantine_stations,
    "quarantine_torn_records": quarantine_torn_records,
    "ingest_stamp": ingest_stamps,
    "regional_extract_records": regional_extract_records,
    "regional_extract_counts": regional_extract_counts,
    "page_completeness": page_completeness,
    "static_points": static_points,
    "refined_tables": refined_tables,
    "stream_snapshot": stream_snapshot,
    "stream_snapshot_checked": stream_snapshot_checked,
    "stream_append": stream_append,
    "stream_first_seen": stream_first_seen,
    "stream_state": stream_state,
    "audited_tables": audited_tables,
    "stream_rejects": stream_rejects,
    "lots_compacted": lots_compacted,
    "snapshot_partition_read": snapshot_partition_read,
}
