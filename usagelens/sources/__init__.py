"""Sources: the six telecom inputs, their named scans and the readers
(Parquet, JSON documents, CSV/text lines, JDBC) that produce them."""

from usagelens.sources.inputs import UsageInputs
from usagelens.sources.datasets import DATASETS, location_catalogue, plan_catalogue, scan

__all__ = ["UsageInputs", "DATASETS", "scan", "plan_catalogue", "location_catalogue"]
