"""The same results as plain DuckDB SQL over the test tables."""

from testbed.views import AS_OF, duck

# Distance by the chord between unit vectors; NULL if a coordinate is, since NULL + … is.
_KM = (
    "12742.0e0 * asin(sqrt(pow(cos(radians({lat1})) * cos(radians({lon1})) - cos(radians({lat2})) * cos(radians({lon2})), 2)"
    " + pow(cos(radians({lat1})) * sin(radians({lon1})) - cos(radians({lat2})) * sin(radians({lon2})), 2)"
    " + pow(sin(radians({lat1})) - sin(radians({lat2})), 2)) / 2)"
)


def _km(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return _KM.format(lat1=lat1, lon1=lon1, lat2=lat2, lon2=lon2)


def _title(c: str) -> str:
    return (
        f"array_to_string(list_transform(string_split({c}, ' '),"
        " lambda x: upper(x[1]) || lower(x[2:])), ' ')"
    )


def _round(c: str, digits: int) -> str:
    """Half-up on the shortest decimal text of a double."""
    text = f"cast(cast({c} as varchar) as decimal(38, 20))"
    return f"cast(round({text}, {digits}) as double)"


def _pct(part: str, whole: str) -> str:
    return f"round(cast({part} as double) / {whole} * 100, 1) + 0.0"


def _with(**ctes: str) -> str:
    return "with " + ", ".join(f"{name} as ({sql})" for name, sql in ctes.items()) + " "


_stations = f"""
    select {_title('nom')} as nom_gare, libellecourt as trigramme, codes_uic, segment_drg,
        codeinsee as code_insee, lat as latitude, lon as longitude, ingested_at,
        {_round('lat', 2)} as lat_grid, {_round('lon', 2)} as lon_grid,
        cast({_round('lat', 2)} as varchar) || '_' || cast({_round('lon', 2)} as varchar) as geo_cell
    from ({duck('stations')})
    where codes_uic is not null and lat between 41 and 52 and lon between -5.5 and 10
    qualify row_number() over (partition by codes_uic order by ingested_at, nom) = 1"""


def _travellers(c: str) -> str:
    return f"greatest(coalesce(cast(trunc({c}) as bigint), 0), 0)"


def _change(v24: str, v19: str) -> str:
    return f"case when {v19} > 0 then {_pct(f'({v24} - {v19})', v19)} end"


_ridership = f"""
    select *, {_change('voyageurs_2024', 'voyageurs_2019')} as evolution_pct_2019_2024
    from (
        select {_title('nom_gare')} as nom_gare, code_uic_complet as code_uic, code_postal,
            segmentation_drg as segment_drg,
            {_travellers('total_voyageurs_2024')} as voyageurs_2024,
            {_travellers('total_voyageurs_2023')} as voyageurs_2023,
            {_travellers('total_voyageurs_2022')} as voyageurs_2022,
            {_travellers('total_voyageurs_2019')} as voyageurs_2019, ingested_at
        from ({duck('ridership')})
        qualify row_number() over (partition by code_uic_complet order by ingested_at) = 1)"""


def _availability(order: str = "ingested_at", weekday: str = "cast(isodow(day) - 1 as integer)"):
    return f"""
    select day as date_depart, train_no, axe, origine, destination, origine_iata,
        destination_iata, heure_depart, heure_arrivee, od_happy_card, ingested_at,
        od_happy_card = 'OUI' as est_disponible, origine || '->' || destination as od,
        {weekday} as jour_semaine, {weekday} in (5, 6) as est_weekend,
        109.9e0 as co2_economise_kg
    from (select *, cast(date as date) as day from ({duck('availability')}))
    where day >= date '{AS_OF}'
    qualify row_number() over (partition by train_no, day, origine, destination
        order by {order}) = 1"""


_rated = f"""
    select *, {_pct('(nb_train_prevu - nb_annulation - nb_train_retard)', 'nb_train_prevu')}
            as taux_regularite_pct,
        {_pct('nb_annulation', 'nb_train_prevu')} as taux_annulation_pct,
        substr(periode, 1, 4) as annee, substr(periode, 6, 2) as mois
    from (
        select date as periode, gare_depart, gare_arrivee, nb_train_prevu,
            coalesce(nb_annulation, 0) as nb_annulation,
            coalesce(nb_train_retard_arrivee, 0) as nb_train_retard,
            retard_moyen_arrivee as retard_moyen_min,
            coalesce(nb_train_retard_sup_15, 0) as nb_retard_sup_15,
            coalesce(nb_train_retard_sup_30, 0) as nb_retard_sup_30,
            prct_cause_externe as pct_cause_externe, prct_cause_infra as pct_cause_infra,
            prct_cause_materiel_roulant as pct_cause_materiel, ingested_at
        from ({duck('punctuality')}) where nb_train_prevu > 0)"""
_first_copy = """row_number() over (partition by periode, gare_depart, gare_arrivee
    order by ingested_at) = 1"""
_punctuality = f"""
    select * from (select * from ({_rated}) qualify {_first_copy})
    where taux_regularite_pct between 0 and 100"""

_regional = f"""
    select * from ({duck('stations')}) where lat between 43 and 47 and lon between -2 and 2.5"""


def _pairs(points: str, radius: float = 10.0) -> str:
    km = _km("latitude", "longitude", "plat", "plon")
    return f"""
    select codes_uic, nom_gare, poi_id, {km} as km
    from ({_stations}) s join ({duck(points)}) p on {km} <= {radius}"""


def _vector(name: str, lat: str, lon: str) -> str:
    return (
        f"cos(radians({lat})) * cos(radians({lon})) as {name}x, cos(radians({lat})) * sin(radians({lon})) as {name}y, sin(radians({lat})) as {name}z"
    )


# Consecutive points of each route, ends and normal as vectors.
_lines = f"""
    select *, uy * vz - uz * vy as nx, uz * vx - ux * vz as ny, ux * vy - uy * vx as nz
    from (select *, {_vector('u', 'from_lat', 'from_lon')}, {_vector('v', 'to_lat', 'to_lon')}
        from (select route, plat as from_lat, plon as from_lon,
                case when first_point and last_point then plat else next_lat end as to_lat,
                case when first_point and last_point then plon else next_lon end as to_lon
            from (select *, lead(plat) over w as next_lat, lead(plon) over w as next_lon,
                    row_number() over w = 1 as first_point, lead(plat) over w is null as last_point
                from ({duck('cycle_routes')}) window w as (partition by route order by plon, poi_id)))
        where to_lat is not null)"""
_LINE_KM = """6371.0e0 * case
    when nx * nx + ny * ny + nz * nz > 1e-24
        and px * (ny * uz - nz * uy) + py * (nz * ux - nx * uz) + pz * (nx * uy - ny * ux) >= 0
        and px * (vy * nz - vz * ny) + py * (vz * nx - vx * nz) + pz * (vx * ny - vy * nx) >= 0
    then asin(least(abs(px * nx + py * ny + pz * nz) / sqrt(nx * nx + ny * ny + nz * nz), 1))
    else 2 * least(asin(sqrt((px - ux) * (px - ux) + (py - uy) * (py - uy) + (pz - uz) * (pz - uz)) / 2),
        asin(sqrt((px - vx) * (px - vx) + (py - vy) * (py - vy) + (pz - vz) * (pz - vz)) / 2)) end"""
_station_vectors = f"select codes_uic, {_vector('p', 'latitude', 'longitude')} from ({_stations})"
_reachable_lines = f"select distinct l.* from ({_lines}) l join ({_station_vectors}) s on {_LINE_KM} <= 10.0"


# One place per name, the smallest; cleaned stations only: a place inside the country, and a code.
_place = f"""
    select 'GARE ' || trim(substr(nom, 6)) as name, first(lat order by lat, lon) as lat, first(lon order by lat, lon) as lon
    from ({duck('gare_stations')})
    where lat between 41 and 52 and lon between -5.5 and 10 group by 1"""
_ends = f"""
    select t.*, case when a.name is null or b.name is null then 580.0e0
        else {_km('a.lat', 'a.lon', 'b.lat', 'b.lon')} end as km
    from (select origine, destination, count(*) as n_trains from ({_availability()})
          group by all) t
        left join ({_place}) a on a.name = origine
        left join ({_place}) b on b.name = destination"""

_reached = f"""
    select * from ({duck('points')}) p where exists (
        select 1 from ({duck('cycle_points')}) r
        where {_km('r.plat', 'r.plon', 'p.plat', 'p.plon')} <= 20.0
          and exists (select 1 from ({_stations}) s
                      where {_km('s.latitude', 's.longitude', 'r.plat', 'r.plon')} <= 10.0))"""

_upcoming = f"select * from ({duck('availability')}) where date >= '{AS_OF}'"

_quarantined = f"""
    select case when lat is null then 'missing:latitude'
                when codes_uic is null then 'missing:codes_uic'
                when not (lat between 41 and 52 and lon between -5.5 and 10)
                    then 'outside_country' end as reason
    from ({duck('stations')})"""

ORACLES = {
    "clean_stations": _stations,
    "clean_ridership": _ridership,
    "clean_availability": _availability(),
    "clean_availability_latest": _availability(order="ingested_at desc"),
    "clean_punctuality": _punctuality,
    "clean_punctuality_validated_first": f"""
        select * from ({_rated}) where taux_regularite_pct between 0 and 100
        qualify {_first_copy}""",
    "legacy_weekday": _availability(weekday="cast(dayofweek(day) - 1 as integer)"),
    "props_json_parse": """
        select event_id, cast(json_extract(props, '$.k') as bigint) as k from events""",
    "json_roundtrip": f"select * exclude (ingested_at) from ({duck('ridership')})",
    "message_keys": f"""
        select codes_uic as key, count(*) as n from ({duck('stations')}) group by all""",
    "message_keys_composite": f"""
        select train_no || '_' || date as key, count(*) as n
        from ({duck('availability')}) group by all""",
    "page_records": f"""
        select * from ({duck('ridership')}) union all select * from ({duck('ridership')})""",
    "required_fields_filter": f"""
        select * from ({duck('stations')})
        where codes_uic is not null and lat is not null and lon is not null""",
    "country_box": f"""
        select * from ({duck('stations')})
        where lat between 41 and 52 and lon between -5.5 and 10""",
    "regional_box": f"select nom, codes_uic, lat, lon from ({_regional})",
    "future_dates": f"""
        select cast(date as date) as date_depart, train_no, ingested_at from ({_upcoming})""",
    "axis_date_filter": f"select * from ({_upcoming}) where axe = 'ATLANTIQUE'",
    "axes_date_filter": f"select * from ({_upcoming}) where axe in ('ATLANTIQUE', 'NORD')",
    "substring_filter": f"""
        select date, gare_depart, gare_arrivee, nb_train_prevu
        from ({duck('punctuality')}) where gare_depart like '%BORDEAUX%'""",
    "ridership_semi_join": f"""
        select * from ({duck('ridership')})
        where code_uic_complet in (select codes_uic from ({_regional}))""",
    "stations_with_ridership": f"""
        select codes_uic, s.nom_gare, voyageurs_2024, voyageurs_2019, evolution_pct_2019_2024
        from ({_stations}) s left join ({_ridership}) r on code_uic = codes_uic""",
    "station_point_pairs": f"""
        select codes_uic, poi_id, round(km, 3) as distance_km from ({_pairs('points')})""",
    "station_cycle_pairs": f"""
        select codes_uic, poi_id, round(km, 3) as distance_km from ({_pairs('cycle_points')})""",
    "missing_datasets": f"""
        select distinct origine as nom_gare from ({duck('availability')})
        where origine not in (select nom_gare from ({duck('named_stations')}))""",
    "keep_first": """
        select * from orders qualify row_number() over (
            partition by o_custkey order by o_orderdate, o_orderkey) = 1""",
    "keep_last": """
        select * from orders qualify row_number() over (
            partition by o_custkey order by o_orderdate desc, o_orderkey desc) = 1""",
    "keep_first_null_key": f"""
        select gare_arrivee, count(*) as n
        from (select * from ({_rated}) qualify {_first_copy}) group by all""",
    "distinct_rows": f"select * from ({duck('availability')}) union select * from ({duck('availability')})",
    "clamp_and_change": f"""
        select *, {_change('v24', 'v19')} as change_pct from (
            select code_uic_complet, ingested_at, {_travellers('total_voyageurs_2024')} as v24,
                {_travellers('total_voyageurs_2019')} as v19 from ({duck('ridership')}))""",
    "rates_validated": f"""
        select periode, gare_depart, gare_arrivee, ingested_at, nb_train_prevu,
            taux_regularite_pct, taux_annulation_pct
        from ({_rated}) where taux_regularite_pct between 0 and 100""",
    "calendar_features": f"""
        select ingested_at, cast(date as date) as day,
            cast(isodow(cast(date as date)) - 1 as integer) as weekday,
            isodow(cast(date as date)) >= 6 as weekend,
            substr(date, 1, 4) as year, substr(date, 6, 2) as month
        from ({duck('availability')})""",
    "text_features": f"""
        select ingested_at, origine || '->' || destination as od, {_title('axe')} as axis_name,
            109.9e0 as co2_kg from ({duck('availability')})""",
    "geo_cell": f"""
        select nom, {_round('lat', 2)} as lat_grid, {_round('lon', 2)} as lon_grid,
            cast({_round('lat', 2)} as varchar) || '_' || cast({_round('lon', 2)} as varchar) as cell
        from ({duck('stations')}) where lat is not null""",
    "poi_within_10km": f"""
        select codes_uic, nom_gare, count(*) as n_points, arg_min(poi_id, km) as nearest_poi_id,
            round(min(km), 3) as nearest_km
        from ({_pairs('points')}) group by all""",
    "station_nearest_point": f"""
        select codes_uic, cast(1 as integer) as rank, poi_id, round(km, 3) as distance_km
        from (select codes_uic, poi_id, {_km('latitude', 'longitude', 'plat', 'plon')} as km from ({_stations}) s, ({duck('points')}) p)
        qualify row_number() over (partition by codes_uic order by km, poi_id) = 1""",
    "station_routes": f"""
        select codes_uic, route, round(min({_LINE_KM}), 3) as distance_km
        from ({_station_vectors}) s join ({_lines}) l on {_LINE_KM} <= 10.0 group by all""",
    "bike_reach_by_route": f"""
        select round(plat, 0) as zone_lat, round(plon, 0) + 0.0 as zone_lon, count(distinct poi_id) as n_points
        from (select poi_id, plat, plon, {_vector('p', 'plat', 'plon')} from ({duck('points')})) p
            join ({_reachable_lines}) l on {_LINE_KM} <= 20.0 group by all""",
    "weekend_seats_by_od": f"""
        select od, count(*) as n_trains from ({_availability()})
        where date_depart in (date '1998-07-04', date '1998-07-05')
          and est_disponible group by all""",
    "co2_by_od": f"""
        select origine, destination, n_trains, round(km, 3) as distance_km,
            round(km * 189.5 / 1000, 3) as co2_saved_kg from ({_ends})""",
    "bike_reach": f"""
        select round(plat, 0) as zone_lat, round(plon, 0) + 0.0 as zone_lon, count(*) as n_points
        from ({_reached}) group by all""",
    "punctuality_trend": f"""
        select annee, mois, cast(sum(nb_train_prevu) as bigint) as trains_planned,
            cast(sum(nb_annulation) as bigint) as trains_cancelled,
            cast(sum(nb_train_retard) as bigint) as trains_late,
            {_pct('sum(nb_train_prevu - nb_annulation - nb_train_retard)', 'sum(nb_train_prevu)')}
                as punctuality_pct
        from ({_punctuality}) group by annee, mois""",
    "quarantine_reasons": f"""
        select reason, count(*) as n from ({_quarantined}) where reason is not null group by all""",
    "quarantine_torn_records": f"""
        select 'unreadable' as reason, count(*) as n from ({duck('ridership')})""",
    "ingest_stamp": """
        select event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ingested_at from events""",
    "regional_extract_records": f"""
        select train_no || '_' || date as key, date, train_no, origine, destination,
            cast(length(axe) as bigint) as n_axe, axe as axes, '1998-07-01T12:00:00Z' as ingested_at
        from ({_upcoming}) where axe in ('ATLANTIQUE', 'NORD')""",
    "regional_extract_counts": f"""
        select dataset, count(*) as n from (
            select 'gares' as dataset from ({_regional})
            union all select 'frequentation' from ({duck('ridership')})
                where code_uic_complet in (select codes_uic from ({_regional}))
            union all select 'tgvmax' from ({_upcoming}) where axe = 'ATLANTIQUE'
            union all select 'regularite' from ({duck('punctuality')}) where contains(gare_depart, 'BORDEAUX'))
        group by all""",
    "page_completeness": f"""
        select right(code_uic_complet, 1) as pull, count(*) as expected,
            count(*) filter (ingested_at < '2024-01-01T12' or right(code_uic_complet, 1) in ('0', '2', '4', '6', '8'))
                as landed,
            cast(0 as bigint) as torn, right(code_uic_complet, 1) in ('0', '2', '4', '6', '8') as complete
        from ({duck('ridership')}) group by all""",
    "static_points": duck("points"),
    "refined_tables": f"""
        select 'gares' as dataset, count(*) as n, count(*) as written from ({_stations})
        union all select 'frequentation', count(*), count(*) from ({_ridership})
        union all select 'tgvmax', count(*), count(*) from ({_availability(order='ingested_at desc')})
        union all select 'regularite', count(*) filter (taux_regularite_pct between 0 and 100), count(*)
            from (select * from ({_rated}) qualify {_first_copy})""",
    "stream_snapshot": _stations,
    "stream_snapshot_checked": _punctuality,
    "stream_append": _availability(order="ingested_at desc"),
    "stream_first_seen": f"""
        select train_no, date_depart, origine, destination, cast(1 as bigint) as n
        from ({_availability()})""",
    "audited_tables": f"""
        select dataset from (
            select 'gares' as dataset, count(*) as n from ({_stations})
            union all select 'frequentation', count(*) from ({_ridership})
            union all select 'tgvmax', count(*) from ({duck('availability')}) where cast(date as date) >= date '2999-01-01'
            union all select 'regularite', count(*) from ({_punctuality}))
        where n = 0""",
    "stream_rejects": f"""
        select reason, count(*) as n from ({_quarantined}) where reason is not null group by all
        union all select 'stored', count(*) from ({_stations})""",
    "stream_state": f"""
        select train_no, date_depart, origine, destination, true as held from ({_availability()})""",
    "lots_compacted": _punctuality,
    "snapshot_partition_read": f"select * from ({_punctuality}) where periode = '1998-07'",
}
