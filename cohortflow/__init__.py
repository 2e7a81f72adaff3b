"""Rule-driven cohort compliance reporting as composable PySpark DataFrame operators."""

from cohortflow.config import DEFAULT_AS_OF, DEFAULT_POLICY, Policy
from cohortflow.plans.pipeline import ReportPipeline
from cohortflow.sources.tables import Sources

__all__ = ["DEFAULT_AS_OF", "DEFAULT_POLICY", "Policy", "ReportPipeline", "Sources"]
