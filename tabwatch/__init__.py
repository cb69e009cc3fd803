"""tabwatch: data quality, training, registry and drift monitoring for tabular classifiers, on Spark."""

from tabwatch.schema import CHURN, DatasetContract, MonitorConfig, TrainingConfig

__all__ = ["CHURN", "DatasetContract", "MonitorConfig", "TrainingConfig"]
