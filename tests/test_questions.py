from datetime import date

import pytest

from trainlake.plans import questions


@pytest.mark.parametrize(
    "as_of, first, last",
    [
        ("2024-01-01", "2024-01-06", "2024-01-07"),  # Monday
        ("2024-01-02", "2024-01-06", "2024-01-07"),
        ("2024-01-03", "2024-01-06", "2024-01-07"),
        ("2024-01-04", "2024-01-06", "2024-01-07"),
        ("2024-01-05", "2024-01-06", "2024-01-07"),
        ("2024-01-06", "2024-01-06", "2024-01-07"),  # Saturday: this one, not the next as well
        ("2024-01-07", "2024-01-07", "2024-01-07"),
    ],
)
def test_weekend_seats_on_every_day_of_a_week(spark, as_of, first, last):
    assert questions.this_weekend(as_of) == (date.fromisoformat(first), date.fromisoformat(last))
    trains = spark.sql("""select 'A->B' as od, true as est_disponible, true as est_weekend, d as date_depart
        from (select explode(sequence(date'2023-12-25', date'2024-01-20')) as d)""")
    (row,) = questions.weekend_seats(trains, as_of).collect()
    assert row.n_trains == (2 if first != last else 1)


def test_co2_by_connection_meets_names_and_defaults(spark):
    trains = spark.createDataFrame(
        [("BORDEAUX", "ANGOULEME"), ("BORDEAUX", "NOWHERE"), (None, "BORDEAUX"), ("LIMBO", "BORDEAUX")],
        "origine STRING, destination STRING",
    )
    stations = spark.createDataFrame(
        [("Bordeaux ", 44.8, -0.55), ("bordeaux", 45.8, -0.55), ("Angouleme", 45.65, 0.16), ("Limbo", None, 1.0)],
        "nom_gare STRING, latitude DOUBLE, longitude DOUBLE",
    )
    found = {(r.origine, r.destination): r for r in questions.co2_by_connection(trains, stations).collect()}
    assert len(found) == 4  # a name that occurs twice doubles nothing
    assert found["BORDEAUX", "ANGOULEME"].distance_km == pytest.approx(110, abs=2)
    for pair in (("BORDEAUX", "NOWHERE"), (None, "BORDEAUX"), ("LIMBO", "BORDEAUX")):
        assert found[pair].distance_km == 580.0 and found[pair].co2_saved_kg == 109.91


def test_emission_factors(spark):
    table = spark.createDataFrame([("car", 200.0), ("train", 3.0), ("bus", 9.0)], "mode STRING, g_per_km DOUBLE")
    assert questions.emission_factors(table) == (200.0, 3.0)


def test_co2_by_od_has_both_known_and_unknown_ends(spark):
    from testbed.queries import QUERIES

    km = [r.distance_km for r in QUERIES["co2_by_od"](spark, "/root/testdata/sf0.001").collect()]
    assert 580.0 in km and any(k != 580.0 for k in km) and max(km) < 2500
