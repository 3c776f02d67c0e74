"""Cleaning and event-time reporting pipelines as plain PySpark DataFrame functions."""

from auditflow.operators.rules import ReportRules
from auditflow.session import build_session, stage, workspace

__all__ = ["ReportRules", "build_session", "stage", "workspace"]
