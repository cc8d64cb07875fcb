"""The four datasets by table name."""

from trainlake.dataset import Dataset
from trainlake.plans.availability import AVAILABILITY
from trainlake.plans.punctuality import PUNCTUALITY
from trainlake.plans.ridership import RIDERSHIP
from trainlake.plans.stations import STATIONS

DATASETS: dict[str, Dataset] = {
    d.name: d for d in (STATIONS, RIDERSHIP, AVAILABILITY, PUNCTUALITY)
}
