"""Registered queries, one module per operator family."""

from factloom.suite import (  # noqa: F401
    coverage_cases,
    evidence_cases,
    fact_cases,
    issue_cases,
    key_cases,
    reshape_cases,
    resolve_cases,
    scalar_cases,
    selector_cases,
    source_cases,
    target_cases,
)
from factloom.suite.registry import ORACLES, QUERIES  # noqa: F401
