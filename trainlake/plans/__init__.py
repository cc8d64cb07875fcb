"""What the library computes: the four cleaned tables and what is asked of them."""

from trainlake.plans.audit import audit_silver, missing_datasets, page_completeness, require_complete
from trainlake.plans.availability import availability, clean_availability
from trainlake.dataset import Dataset, clean, quarantine
from trainlake.plans.extract import regional_extract
from trainlake.plans.punctuality import clean_punctuality
from trainlake.plans.ridership import clean_ridership
from trainlake.plans.stations import clean_stations
from trainlake.plans.registry import DATASETS

__all__ = [
    "DATASETS",
    "Dataset",
    "audit_silver",
    "availability",
    "clean",
    "clean_availability",
    "clean_punctuality",
    "clean_ridership",
    "clean_stations",
    "missing_datasets",
    "page_completeness",
    "require_complete",
    "quarantine",
    "regional_extract",
]
