"""Collects the registered queries and oracles of every plan module."""

from __future__ import annotations

import importlib

PLAN_MODULES = [
    "driftcheck.plans.parity_plans",
    "driftcheck.plans.log_plans",
    "driftcheck.plans.triage_plans",
    "driftcheck.plans.conf_plans",
    "driftcheck.plans.runstate_plans",
    "driftcheck.plans.stream_plans",
    "driftcheck.plans.io_plans",
]


def _modules():
    return [importlib.import_module(m) for m in PLAN_MODULES]


def queries() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql() -> dict:
    out: dict = {}
    for m in _modules():
        out.update(getattr(m, "ORACLE", {}))
    return out
