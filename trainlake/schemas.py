"""Record layouts and other values that producers and readers share."""

# ---------------------------------------------------------------------------
# Field names, types, codes and boxes of the published interface.
# The train counters are DOUBLE on the wire so that `12.0` is read as 12.
# ---------------------------------------------------------------------------

STATIONS_WIRE = """
    nom STRING, libellecourt STRING, codes_uic STRING, segment_drg STRING, codeinsee STRING,
    position_geographique STRUCT<lat: DOUBLE, lon: DOUBLE>, ingested_at STRING
"""
STATIONS_SILVER = """
    nom_gare STRING, trigramme STRING, codes_uic STRING, segment_drg STRING, code_insee STRING,
    latitude DOUBLE, longitude DOUBLE, ingested_at STRING,
    lat_grid DOUBLE, lon_grid DOUBLE, geo_cell STRING, processed_at TIMESTAMP
"""

RIDERSHIP_WIRE = """
    nom_gare STRING, code_uic_complet STRING, code_postal STRING, segmentation_drg STRING,
    total_voyageurs_2024 DOUBLE, total_voyageurs_2023 DOUBLE,
    total_voyageurs_2022 DOUBLE, total_voyageurs_2019 DOUBLE, ingested_at STRING
"""
RIDERSHIP_SILVER = """
    nom_gare STRING, code_uic STRING, code_postal STRING, segment_drg STRING,
    voyageurs_2024 BIGINT, voyageurs_2023 BIGINT, voyageurs_2022 BIGINT, voyageurs_2019 BIGINT,
    ingested_at STRING, evolution_pct_2019_2024 DOUBLE, processed_at TIMESTAMP
"""

AVAILABILITY_WIRE = """
    date STRING, train_no STRING, axe STRING, origine STRING, destination STRING,
    origine_iata STRING, destination_iata STRING, heure_depart STRING, heure_arrivee STRING,
    od_happy_card STRING, ingested_at STRING
"""
AVAILABILITY_SILVER = """
    date_depart DATE, train_no STRING, axe STRING, origine STRING, destination STRING,
    origine_iata STRING, destination_iata STRING, heure_depart STRING, heure_arrivee STRING,
    od_happy_card STRING, ingested_at STRING, est_disponible BOOLEAN, od STRING,
    jour_semaine INT, est_weekend BOOLEAN, co2_economise_kg DOUBLE, processed_at TIMESTAMP
"""

PUNCTUALITY_WIRE = """
    date STRING, gare_depart STRING, gare_arrivee STRING, nb_train_prevu DOUBLE,
    nb_annulation DOUBLE, nb_train_retard_arrivee DOUBLE, retard_moyen_arrivee DOUBLE,
    nb_train_retard_sup_15 DOUBLE, nb_train_retard_sup_30 DOUBLE, prct_cause_externe DOUBLE,
    prct_cause_infra DOUBLE, prct_cause_materiel_roulant DOUBLE, ingested_at STRING
"""
PUNCTUALITY_SILVER = """
    periode STRING, gare_depart STRING, gare_arrivee STRING, nb_train_prevu INT,
    nb_annulation INT, nb_train_retard INT, retard_moyen_min DOUBLE,
    nb_retard_sup_15 INT, nb_retard_sup_30 INT, pct_cause_externe DOUBLE,
    pct_cause_infra DOUBLE, pct_cause_materiel DOUBLE, ingested_at STRING,
    taux_regularite_pct DOUBLE, taux_annulation_pct DOUBLE, annee STRING, mois STRING,
    processed_at TIMESTAMP
"""

AVAILABLE_FLAG = "OUI"
COUNTRY_LAT = (41.0, 52.0)
COUNTRY_LON = (-5.5, 10.0)
REGION_LAT = (43.0, 47.0)
REGION_LON = (-2.0, 2.5)
MAIN_AXIS = "ATLANTIQUE"
MAIN_STATION = "BORDEAUX"

# ---------------------------------------------------------------------------
# Layouts of our own.
# ---------------------------------------------------------------------------

POINTS = "poi_id BIGINT, name STRING, kind STRING, plat DOUBLE, plon DOUBLE"
EMISSION_FACTORS = "mode STRING, g_per_km DOUBLE"
