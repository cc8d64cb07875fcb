"""The four cleaned tables on clean, dirty and duplicate records."""

import datetime as dt

import pytest

from trainlake.dataset import clean, quarantine
from trainlake.plans import (
    clean_availability,
    clean_punctuality,
    clean_ridership,
    clean_stations,
)
from trainlake.plans.availability import availability
from trainlake.plans.punctuality import PUNCTUALITY
from trainlake.plans.ridership import RIDERSHIP
from trainlake.plans.stations import STATIONS
from trainlake.plans.registry import DATASETS


def station(code="87000001", lat=44.826, lon=-0.556, **more):
    return {
        "nom": "BORDEAUX SAINT-JEAN", "libellecourt": "BXJ", "codes_uic": code,
        "segment_drg": "A", "codeinsee": "33063",
        "position_geographique": {"lat": lat, "lon": lon},
        "ingested_at": "2024-01-01T00:00:00Z", **more,
    }


def ridership(code="87000001", **more):
    return {"nom_gare": "BORDEAUX", "code_uic_complet": code, "code_postal": "33800",
            "ingested_at": "2024-01-01T00:00:00Z", **more}


def seat(date="2024-01-07", train="8501", **more):
    return {"date": date, "train_no": train, "axe": "ATLANTIQUE", "origine": "BORDEAUX",
            "destination": "PARIS", "od_happy_card": "OUI",
            "ingested_at": "2024-01-01T00:00:00Z", **more}


def month(planned=100, cancelled=None, late=None, **more):
    return {"date": "2024-03", "gare_depart": "BORDEAUX", "gare_arrivee": "PARIS",
            "nb_train_prevu": planned, "nb_annulation": cancelled,
            "nb_train_retard_arrivee": late, "ingested_at": "2024-01-01T00:00:00Z", **more}


# -- schemas ----------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(DATASETS))
def test_silver_schema_is_the_declared_one(spark, raw, name):
    declared = spark.createDataFrame([], DATASETS[name].silver)
    assert clean(DATASETS[name], raw("{}")).dtypes == declared.dtypes


@pytest.mark.parametrize("name", sorted(DATASETS))
def test_plan_parses_once_and_shuffles_once(raw, plan, name):
    text = plan(clean(DATASETS[name], raw("{}")))
    assert text.count("from_json") == 1
    assert text.count("Exchange") == 1
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", sorted(DATASETS))
def test_unreadable_records_are_dropped_without_error(raw, name):
    assert clean(DATASETS[name], raw('{"a":1', "null", "[]", "", "{}", "42")).count() == 0


# -- stations ---------------------------------------------------------------


def test_stations(raw):
    (row,) = clean_stations(raw(station())).collect()
    assert row.nom_gare == "Bordeaux Saint-jean"
    assert (row.trigramme, row.code_insee) == ("BXJ", "33063")
    assert (row.lat_grid, row.lon_grid, row.geo_cell) == (44.83, -0.56, "44.83_-0.56")
    assert isinstance(row.processed_at, dt.datetime)


def test_stations_keep_the_edges_of_the_country(raw):
    edges = [(41, 0), (52, 0), (45, -5.5), (45, 10), (45.0, 0.0)]
    beyond = [(40.999, 0), (52.001, 0), (45, -5.501), (45, 10.001)]
    records = [station(str(i), *at) for i, at in enumerate(edges + beyond)]
    assert {r.codes_uic for r in clean_stations(raw(*records)).collect()} == set("01234")


def test_stations_need_code_and_position(raw):
    none = [station(None), station(lat=None), station(position_geographique=None),
            station(position_geographique="x")]
    assert clean_stations(raw(*none)).count() == 0


def test_station_survivor_is_the_earliest_then_by_content(raw):
    late = station(ingested_at="2024-01-02T00:00:00Z", nom="A")
    unstamped = station(ingested_at=None, nom="0")
    tie = station(nom="AA")
    for records in ([late, station(), unstamped, tie], [tie, unstamped, station(), late]):
        (row,) = clean_stations(raw(*records)).collect()
        assert row.nom_gare == "Aa"
    (row,) = clean_stations(raw(late, station(), unstamped), keep="last").collect()
    assert row.nom_gare == "A"


def test_array_of_codes_is_kept_as_text(raw):
    (row,) = clean_stations(raw(station(["87", "88"]))).collect()
    assert row.codes_uic == '["87","88"]'


# -- ridership --------------------------------------------------------------


def test_ridership_numbers(raw):
    record = ridership(total_voyageurs_2024=150.9, total_voyageurs_2023=-3,
                       total_voyageurs_2019=100)
    (row,) = clean_ridership(raw(record)).collect()
    assert (row.voyageurs_2024, row.voyageurs_2023, row.voyageurs_2022) == (150, 0, 0)
    assert row.evolution_pct_2019_2024 == 50.0


@pytest.mark.parametrize("value", ["NaN", "1e30", "null"])
def test_ridership_that_is_no_number_is_zero(raw, value):
    text = '{"nom_gare":"A","code_uic_complet":"1","total_voyageurs_2019":%s}' % value
    (row,) = clean_ridership(raw(text)).collect()
    assert row.voyageurs_2019 == 0 and row.evolution_pct_2019_2024 is None


# -- availability -----------------------------------------------------------


def test_availability(raw):
    (row,) = clean_availability(raw(seat()), "2024-01-01").collect()
    assert row.date_depart == dt.date(2024, 1, 7)
    assert row.est_disponible is True and row.est_weekend is True
    assert (row.od, row.jour_semaine, row.co2_economise_kg) == ("BORDEAUX->PARIS", 6, 109.9)


def test_availability_legacy_sunday(raw):
    row = clean_availability(raw(seat()), "2024-01-01", legacy_weekday=True).first()
    assert (row.jour_semaine, row.est_weekend) == (-1, False)


def test_availability_from_as_of_on(raw):
    days = [seat("2024-01-06", "1"), seat("2024-01-07", "2"), seat("2024-01-08", "3")]
    found = clean_availability(raw(*days), "2024-01-07").collect()
    assert {r.train_no for r in found} == {"2", "3"}


def test_availability_default_is_today(raw):
    today = dt.datetime.now(dt.timezone.utc).date()
    days = [seat(str(today - dt.timedelta(2)), "1"), seat(str(today + dt.timedelta(2)), "2")]
    assert [r.train_no for r in clean_availability(raw(*days)).collect()] == ["2"]


def test_availability_bad_dates_and_flags(raw):
    records = [seat("2025/01/02", "1"), seat("abc", "2"), seat(None, "3"),
               seat("2025-01-02", "4", od_happy_card=None),
               seat("2025-01-02", "5", od_happy_card="NON")]
    found = clean_availability(raw(*records), "2024-01-01").collect()
    assert {r.train_no: r.est_disponible for r in found} == {"4": None, "5": False}


def test_availability_last_report_shows_the_changed_flag(raw):
    later = seat(od_happy_card="NON", ingested_at="2024-01-01T00:01:00Z")
    for keep, flag in (("first", "OUI"), ("last", "NON")):
        (row,) = clean_availability(raw(later, seat()), "2024-01-01", keep).collect()
        assert row.od_happy_card == flag


# -- punctuality ------------------------------------------------------------


def test_punctuality(raw):
    (row,) = clean_punctuality(raw(month(100, 5, 10))).collect()
    assert (row.taux_regularite_pct, row.taux_annulation_pct) == (85.0, 5.0)
    assert (row.annee, row.mois, row.nb_retard_sup_15) == ("2024", "03", 0)


def test_punctuality_counters_in_other_spellings(raw):
    (row,) = clean_punctuality(raw(month(12.0, "3", None))).collect()
    assert (row.nb_train_prevu, row.nb_annulation, row.nb_train_retard) == (12, 0, 0)


def test_punctuality_drops_what_cannot_be(raw):
    impossible = [month(5, 4, 3), month(0), month(-1), month(None), month(3000000000), month("7")]
    assert clean_punctuality(raw(*impossible)).count() == 0


def test_punctuality_does_not_overflow(raw):
    assert clean_punctuality(raw(month(1, 2147483647, 2147483647))).count() == 0


def test_punctuality_null_arrival_is_one_group(raw):
    records = [month(10, gare_arrivee=None), month(20, gare_arrivee=None)]
    assert clean_punctuality(raw(*records)).count() == 1


def test_punctuality_bad_first_copy_hides_a_good_second_one(raw):
    bad, good = month(5, 4, 3), month(5, 1, 1, ingested_at="2024-01-02T00:00:00Z")
    assert clean_punctuality(raw(bad, good)).count() == 0
    (row,) = clean_punctuality(raw(bad, good), validate_first=True).collect()
    assert row.taux_regularite_pct == 60.0


# -- properties -------------------------------------------------------------


@pytest.mark.parametrize(
    "name, record",
    [("gares", station()), ("frequentation", ridership()), ("tgvmax", seat("2999-01-01")),
     ("regularite", month())],
)
def test_more_copies_change_nothing(raw, name, record):
    once = clean(DATASETS[name], raw(record), stamp=False).collect()
    often = clean(DATASETS[name], raw(*[record] * 5).repartition(3), stamp=False).collect()
    assert once == often and len(once) == 1


# -- quarantine -------------------------------------------------------------


def reasons(dataset, df):
    return sorted(r.reason for r in quarantine(dataset, df).collect())


def test_quarantine_of_unreadable_records(raw):
    df = raw('{"a":1', "null", "[]", "")
    assert reasons(STATIONS, df) == ["unreadable"] * 4
    kept = {r.json_str for r in quarantine(STATIONS, df).collect()}
    assert kept == {'{"a":1', "null", "[]", ""}


def test_quarantine_reasons(raw):
    assert reasons(STATIONS, raw(station(), station(lat=60.0), station(None))) == [
        "missing:codes_uic", "outside_country",
    ]
    assert reasons(PUNCTUALITY, raw(month("12"), month(3e9), month(0), month(5, 4, 3))) == [
        "bad_field", "impossible_rate", "no_planned_train", "overflow:nb_train_prevu",
    ]
    assert reasons(RIDERSHIP, raw(ridership(total_voyageurs_2024=1e30))) == [
        "overflow:total_voyageurs_2024"
    ]
    # Past departures and repeated reports are no defects.
    assert reasons(availability("2024-02-01"), raw(seat(), seat(), seat("x"))) == [
        "missing:date_depart"
    ]
