"""Wire records derived from the test tables, as SQL for both engines.

Each view is written once; only the text type and date formatting differ between
Spark and DuckDB.  On the Spark side the rows become JSON text, so every query
starts where a real one does: at raw records.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem", "events")
AS_OF = "1998-07-01"

_SPARK = {
    "S": "string",
    "ship_day": "date_format(l_shipdate, 'yyyy-MM-dd')",
    "order_month": "date_format(o_orderdate, 'yyyy-MM')",
}
_DUCK = {
    "S": "varchar",
    "ship_day": "strftime(l_shipdate, '%Y-%m-%d')",
    "order_month": "strftime(o_orderdate, '%Y-%m')",
}

_VIEWS = {
    # NULL keys and positions, rows outside the box, duplicate keys, rounding ties.
    "stations": """
        select upper(c_mktsegment || ' ' || c_name) as nom,
            substr(c_mktsegment, 1, 3) as libellecourt,
            case when c_custkey % 23 = 0 then null else '87' || lpad(cast(
                c_custkey - (case when c_custkey % 10 = 9 then 1 else 0 end)
                as {S}), 6, '0') end as codes_uic,
            substr(c_mktsegment, 1, 1) as segment_drg,
            lpad(cast(c_nationkey as {S}), 5, '0') as codeinsee,
            case when c_custkey % 17 = 0 then null
                 else 40.0e0 + (c_custkey * 7919 % 14000) / 1000.0e0 end as lat,
            case when c_custkey % 17 = 0 then null
                 else -7.0e0 + (c_custkey * 104729 % 19000) / 1000.0e0 end as lon,
            '2024-01-01T00:00:' || lpad(cast(c_custkey % 60 as {S}), 2, '0') || 'Z' as ingested_at
        from customer""",
    # Every station twice: a later report with other numbers must not win.
    "ridership": """
        select c_name as nom_gare, '87' || lpad(cast(c_custkey as {S}), 6, '0') as code_uic_complet,
            lpad(cast(c_custkey % 95000 as {S}), 5, '0') as code_postal,
            substr(c_mktsegment, 1, 1) as segmentation_drg,
            case when c_custkey % 13 = 0 then null else c_acctbal * 100 end as total_voyageurs_2024,
            c_acctbal * 95 as total_voyageurs_2023,
            case when c_custkey % 5 = 0 then null else c_acctbal * 80.5e0 end as total_voyageurs_2022,
            case when c_custkey % 7 = 0 then 0.0e0
                 else c_acctbal * 90 + ((c_custkey * 37) % 1000) end as total_voyageurs_2019,
            '2024-01-01T00:00:00Z' as ingested_at
        from customer
        union all
        select lower(c_name), '87' || lpad(cast(c_custkey as {S}), 6, '0'), '00000', 'Z',
            c_acctbal, c_acctbal, c_acctbal, c_acctbal, '2024-01-02T00:00:00Z'
        from customer""",
    # Duplicate keys, NULL flags, weekends; `ingested_at` orders all rows totally.
    "availability": """
        select {ship_day} as date,
            lpad(cast(l_partkey % 200 as {S}), 4, '0') as train_no,
            case l_linenumber % 3 when 0 then 'ATLANTIQUE' when 1 then 'SUD EST' else 'NORD' end as axe,
            'GARE ' || cast(l_suppkey % 20 as {S}) as origine,
            'GARE ' || cast(l_partkey % 20 as {S}) as destination,
            'FR' || lpad(cast(l_suppkey % 20 as {S}), 3, '0') as origine_iata,
            'FR' || lpad(cast(l_partkey % 20 as {S}), 3, '0') as destination_iata,
            lpad(cast(6 + l_linenumber as {S}), 2, '0') || ':00' as heure_depart,
            lpad(cast(8 + l_linenumber as {S}), 2, '0') || ':30' as heure_arrivee,
            case l_returnflag when 'A' then 'OUI' when 'N' then 'NON' end as od_happy_card,
            lpad(cast(l_orderkey * 10 + l_linenumber as {S}), 14, '0') || '.'
                || lpad(cast(cast(round(l_extendedprice * 100) as bigint) as {S}), 12, '0')
                as ingested_at
        from lineitem""",
    # Counters overlap on purpose, so some rates are impossible; each key twice.
    "punctuality": """
        with monthly as (
            select {order_month} as date,
                case when o_orderpriority like '1%' then 'BORDEAUX ' || o_orderpriority
                     else o_orderpriority end as gare_depart,
                case when c_nationkey = 0 then null
                     else 'GARE ' || cast(c_nationkey as {S}) end as gare_arrivee,
                cast(count(*) as int) as n,
                cast(sum(case when l_returnflag = 'R' then 1 end) as int) as cancelled,
                cast(sum(case when l_linestatus = 'O' and l_quantity > 25 or l_quantity > 45
                              then 1 end) as int) as late,
                cast(sum(case when l_quantity > 46 then 1 end) as int) as late15,
                cast(sum(case when l_quantity > 48 then 1 end) as int) as late30,
                cast(sum(l_linenumber) as bigint) as minutes
            from lineitem join orders on l_orderkey = o_orderkey
                join customer on o_custkey = c_custkey
            group by 1, 2, 3)
        select date, gare_depart, gare_arrivee, n as nb_train_prevu, cancelled as nb_annulation,
            late as nb_train_retard_arrivee,
            cast(minutes as double) / cast(n as double) as retard_moyen_arrivee,
            late15 as nb_train_retard_sup_15, late30 as nb_train_retard_sup_30,
            cast(minutes % 101 as double) as prct_cause_externe,
            cast(minutes % 53 as double) as prct_cause_infra,
            cast(null as double) as prct_cause_materiel_roulant,
            '2024-01-01T00:00:00Z' as ingested_at
        from monthly
        union all
        select date, gare_depart, gare_arrivee, n + 1, 0, 0, 0.0e0, 0, 0, 0.0e0, 0.0e0, 0.0e0,
            '2024-01-02T00:00:00Z'
        from monthly""",
    "points": """
        select s_suppkey as poi_id, s_name as name, 'musee' as kind,
            41.5e0 + (s_suppkey * 6151 % 10000) / 1000.0e0 as plat,
            -5.0e0 + (s_suppkey * 7907 % 14000) / 1000.0e0 as plon
        from supplier""",
    "cycle_points": """
        select p_partkey as poi_id, p_name as name, 'voie verte' as kind,
            41.0e0 + (p_partkey * 3571 % 11000) / 1000.0e0 as plat,
            -5.5e0 + (p_partkey * 9973 % 15500) / 1000.0e0 as plon
        from part""",
    # Routes by degree of latitude: their points lie tens of kilometres apart.
    "cycle_routes": """
        select cast(cast(floor(plat) as int) as {S}) as route, poi_id, plat, plon
        from (select p_partkey as poi_id, 41.0e0 + (p_partkey * 3571 % 11000) / 1000.0e0 as plat,
                -5.5e0 + (p_partkey * 9973 % 15500) / 1000.0e0 as plon
            from part)""",
    # Station records for names that occur in `availability` in another case, some twice at
    # different places, some without a place; some of its stations are missing here.
    "gare_stations": """
        select 'gare  ' || cast(n_nationkey as {S}) as nom, 'GAR' as libellecourt,
            '88' || lpad(cast(n_nationkey * 10 + twice as {S}), 6, '0') as codes_uic, 'A' as segment_drg,
            '00000' as codeinsee,
            case when n_nationkey % 7 = 5 then null else 43.0e0 + (n_nationkey * 37 % 80) / 10.0e0 + twice end as lat,
            case when n_nationkey % 7 = 5 then null else -4.0e0 + (n_nationkey * 53 % 130) / 10.0e0 end as lon,
            '2024-01-01T00:00:00Z' as ingested_at
        from nation cross join (select 0 as twice union all select 1)
        where n_nationkey % 9 <> 4 and (twice = 0 or n_nationkey % 4 = 1)""",
    # Names that occur in `availability`; some of its stations are missing here.
    "named_stations": """
        select 'GARE ' || cast(n_nationkey as {S}) as nom_gare,
            43.0e0 + (n_nationkey * 37 % 80) / 10.0e0 as latitude,
            -4.0e0 + (n_nationkey * 53 % 130) / 10.0e0 as longitude
        from nation where n_nationkey % 9 <> 4""",
}


def duck(view: str) -> str:
    return _VIEWS[view].format(**_DUCK)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rows(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The view as a flat DataFrame."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # Table names become parameters of `spark.sql`: no catalog entry is made.
    sql = re.sub(rf"\b(from|join) ({'|'.join(TABLES)})\b", r"\1 {\2}", _VIEWS[view].format(**_SPARK))
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def wire(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The view as wire records: stations carry their position as a struct."""
    df = rows(spark, sf_dir, view)
    if view not in ("stations", "gare_stations"):
        return df
    position = F.when(F.col("lat").isNotNull(), F.struct("lat", "lon"))
    return df.withColumn("position_geographique", position).drop("lat", "lon")


def raw(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    """The view as raw records, ``json_str``."""
    return wire(spark, sf_dir, view).select(F.to_json(F.struct("*")).alias("json_str"))
