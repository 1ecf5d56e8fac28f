"""Imports every module that registers queries."""

from checks import (  # noqa: F401
    audit_checks,
    catalogue_checks,
    coverage_checks,
    derive_checks,
    function_checks,
    ingest_checks,
    lineage_checks,
    log_checks,
    plan_checks,
    workset_checks,
)
from checks.registry import ORACLES, QUERIES  # noqa: F401
