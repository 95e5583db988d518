"""All registered cases, in survey order."""

from workload import inference_cases, metric_cases, tables_cases  # noqa: F401
from workload.case import CASES

__all__ = ["CASES"]
