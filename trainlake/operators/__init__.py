from trainlake.operators.dedup import distinct_records, first_seen, keep_one
from trainlake.operators.filters import first_rows, require
from trainlake.operators.lines import lines_near_places, places_near_lines, route_segments
from trainlake.operators.nearby import count_within_km, nearest, nearest_within_km
from trainlake.operators.parse import parse_json
from trainlake.operators.spatial import within_km

__all__ = [
    "count_within_km", "distinct_records", "first_rows", "first_seen", "keep_one", "lines_near_places", "nearest", "nearest_within_km",
    "parse_json", "places_near_lines", "require", "route_segments", "within_km",
]
