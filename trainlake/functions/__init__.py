"""Column functions: all of them are compositions of Spark built-ins."""

from trainlake.functions.calendar import (
    is_weekend,
    month_text,
    parse_day,
    weekday_index,
    year_text,
)
from trainlake.functions.carbon import co2_saved_kg
from trainlake.functions.geo import geo_cell, grid_degree, haversine_km, in_box
from trainlake.functions.measures import (
    not_negative,
    pct_change,
    percent,
    whole_number,
)
from trainlake.functions.messages import ingest_stamp, message_key
from trainlake.functions.text import name_key, od_pair, title_case

__all__ = [
    "co2_saved_kg",
    "geo_cell",
    "grid_degree",
    "haversine_km",
    "in_box",
    "ingest_stamp",
    "is_weekend",
    "message_key",
    "month_text",
    "name_key",
    "not_negative",
    "od_pair",
    "parse_day",
    "pct_change",
    "percent",
    "title_case",
    "weekday_index",
    "whole_number",
    "year_text",
]
