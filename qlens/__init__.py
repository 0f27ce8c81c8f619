"""Chat-question analytics on Spark: de-duplicate, classify, reconcile, report."""

from qlens.config import DEFAULTS, SchemaConfig, Settings
from qlens.period import Period
from qlens.plans.runs import RunResult, Workspace, complete_run

__all__ = ["DEFAULTS", "Period", "RunResult", "SchemaConfig", "Settings", "Workspace", "complete_run"]
