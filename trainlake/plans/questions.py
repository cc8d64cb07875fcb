"""Answers on top of the cleaned tables."""

from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trainlake.functions import co2_saved_kg, haversine_km, name_key
from trainlake.functions.carbon import CAR_G_PER_KM, DEFAULT_TRIP_KM, TRAIN_G_PER_KM
from trainlake.operators.lines import ENDS
from trainlake.operators import count_within_km, lines_near_places, nearest, nearest_within_km, places_near_lines, within_km


def stations_with_ridership(stations: DataFrame, ridership: DataFrame) -> DataFrame:
    """Every station with its yearly travellers, NULL where none are reported."""
    travellers = ridership.select(
        F.col("code_uic").alias("codes_uic"),
        "voyageurs_2024", "voyageurs_2023", "voyageurs_2022", "voyageurs_2019",
        "evolution_pct_2019_2024",
    )
    return stations.join(travellers, "codes_uic", "left")


def stations_near_points(
    stations: DataFrame, points: DataFrame, radius_km: float = 10.0
) -> DataFrame:
    """Stations with a point of interest in reach: how many, and the nearest one.

    No pair is formed where a box of points is wholly in reach.
    """
    known = stations.select("codes_uic", "nom_gare", "latitude", "longitude")
    many = count_within_km(known, points, radius_km, ["codes_uic"])
    best = nearest_within_km(known, points, radius_km, ["codes_uic"], "poi_id")
    best = best.select("codes_uic", F.col("poi_id").alias("nearest_poi_id"), F.round("distance_km", 3).alias("nearest_km"))
    return known.select("codes_uic", "nom_gare").join(many, "codes_uic").join(best, "codes_uic")


def nearest_points(stations: DataFrame, points: DataFrame, k: int = 1) -> DataFrame:
    """For every station its ``k`` nearest points of interest, however far."""
    found = nearest(stations, points, ["codes_uic"], "poi_id", k)
    return found.withColumn("distance_km", F.round("distance_km", 3))


def stations_near_routes(stations: DataFrame, segments: DataFrame, radius_km: float = 10.0) -> DataFrame:
    """Stations with a cycle route (``route`` and segments) in reach, with the distance to each such route."""
    pairs = places_near_lines(stations.select("codes_uic", "latitude", "longitude"), segments, radius_km)
    return pairs.groupBy("codes_uic", "route").agg(F.round(F.min("distance_km"), 3).alias("distance_km"))


def this_weekend(as_of: date | str) -> tuple[date, date]:
    """First and last day left of the running weekend, or of the next one on a working day."""
    day = date.fromisoformat(str(as_of))
    saturday = day + timedelta(days=5 - day.weekday())
    return max(day, saturday), saturday + timedelta(days=1)


def weekend_seats(availability: DataFrame, as_of: date | str) -> DataFrame:
    """Connections with free seats on the Saturday and Sunday of ``this_weekend``."""
    first, last = this_weekend(as_of)
    soon = F.col("date_depart").between(F.lit(first), F.lit(last))
    free = availability.where(soon & F.col("est_disponible"))
    return free.groupBy("od").agg(F.count(F.lit(1)).alias("n_trains"))


def co2_by_connection(
    availability: DataFrame,
    stations: DataFrame,
    car_g: float = CAR_G_PER_KM,
    train_g: float = TRAIN_G_PER_KM,
    default_km: float = DEFAULT_TRIP_KM,
) -> DataFrame:
    """CO₂ saved per traveller on each connection, over the great-circle distance.

    ``stations`` has ``nom_gare, latitude, longitude``.  Names meet by ``name_key``,
    as the feeds write them in different cases; of stations with one name the
    smallest position counts, so no connection doubles.  An unknown end gives the
    default distance.  Trains are counted per connection first, so the joins see
    connections only, not trains.
    """
    trips = availability.groupBy("origine", "destination").agg(F.count(F.lit(1)).alias("n_trains"))

    known = stations.where("latitude IS NOT NULL AND longitude IS NOT NULL")
    places = known.groupBy(name_key(F.col("nom_gare")).alias("_name")).agg(
        F.min(F.struct("latitude", "longitude")).alias("_at")
    )

    def end(name: str) -> DataFrame:
        return places.select(
            F.col("_name").alias(f"_key_{name}"),
            F.col("_at.latitude").alias(f"_lat_{name}"),
            F.col("_at.longitude").alias(f"_lon_{name}"),
        )

    def meets(name: str):
        return name_key(F.col(name)) == F.col(f"_key_{name}")

    both = trips.join(end("origine"), meets("origine"), "left").join(
        end("destination"), meets("destination"), "left"
    )
    measured = haversine_km(
        F.col("_lat_origine"), F.col("_lon_origine"),
        F.col("_lat_destination"), F.col("_lon_destination"),
    )
    km = F.coalesce(measured, F.lit(default_km))
    return both.select(
        "origine",
        "destination",
        "n_trains",
        F.round(km, 3).alias("distance_km"),
        co2_saved_kg(km, car_g, train_g, digits=3).alias("co2_saved_kg"),
    )


def emission_factors(table: DataFrame, car: str = "car", train: str = "train") -> tuple[float, float]:
    """Grams per passenger-km by car and by train from a static table ``mode, g_per_km`` (two rows are read)."""
    found = {
        r["mode"]: r["g_per_km"]
        for r in table.where(F.col("mode").isin(car, train)).groupBy("mode").agg(F.min("g_per_km").alias("g_per_km")).collect()
    }
    return found[car], found[train]


def bike_reach(
    stations: DataFrame,
    cycle_points: DataFrame,
    points: DataFrame,
    station_km: float = 10.0,
    point_km: float = 10.0,
    zone_digits: int = 0,
) -> DataFrame:
    """Tourist zones (grid cells) and how many of their points a bike reaches.

    A point counts if a cycle route passes within ``point_km`` of it at a place
    that is within ``station_km`` of a station.  Semi joins throughout: each
    point is kept or not, no station–route–point combinations are formed.
    """
    routes = within_km(
        cycle_points, stations, station_km,
        left_at=("plat", "plon"), right_at=("latitude", "longitude"), how="left_semi",
    )
    reached = within_km(
        points, routes, point_km, left_at=("plat", "plon"), how="left_semi"
    )
    zone = [F.round(c, zone_digits).alias(z) for c, z in (("plat", "zone_lat"), ("plon", "zone_lon"))]
    return reached.groupBy(*zone).agg(F.count(F.lit(1)).alias("n_points"))


def bike_reach_by_route(
    stations: DataFrame, segments: DataFrame, points: DataFrame,
    station_km: float = 10.0, point_km: float = 10.0, zone_digits: int = 0,
) -> DataFrame:
    """As ``bike_reach``, with routes as lines: a point counts if a segment that passes within ``station_km``
    of a station passes within ``point_km`` of it."""
    reachable = lines_near_places(segments.select(*ENDS), stations, station_km)
    reached = places_near_lines(points, reachable, point_km, at=("plat", "plon"), how="left_semi")
    zone = [F.round(c, zone_digits).alias(z) for c, z in (("plat", "zone_lat"), ("plon", "zone_lon"))]
    return reached.groupBy(*zone).agg(F.count(F.lit(1)).alias("n_points"))


def punctuality_trend(punctuality: DataFrame) -> DataFrame:
    """Punctuality by month, weighted by trains (not an average of rounded rates)."""
    planned, cancelled, late = (
        F.sum(c) for c in ("nb_train_prevu", "nb_annulation", "nb_train_retard")
    )
    totals = punctuality.groupBy("annee", "mois").agg(
        planned.alias("trains_planned"),
        cancelled.alias("trains_cancelled"),
        late.alias("trains_late"),
    )
    on_time = F.col("trains_planned") - F.col("trains_cancelled") - F.col("trains_late")
    rate = F.try_divide(on_time.cast("double"), F.col("trains_planned").cast("double"))
    return totals.withColumn("punctuality_pct", F.round(rate * 100, 1))
