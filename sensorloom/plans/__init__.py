"""Registered queries (one per operator group of SURVEY §2) and their SQL oracles."""

from __future__ import annotations

from sensorloom.plans.common import ORACLES, QUERIES, finish, register  # noqa: F401


def load_all() -> None:
    """Import every query module so its ``@register`` calls run."""
    from sensorloom.plans import timeseries  # noqa: F401
    for mod in ("cleaning", "windows", "quality", "features", "bundles", "fitted", "modelling", "expectations",
                "clustering", "optimisation", "io_queries", "reports"):
        try:
            __import__(f"sensorloom.plans.{mod}")
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != f"sensorloom.plans.{mod}":
                raise


def queries():
    load_all()
    return dict(QUERIES)


def oracle_sql():
    load_all()
    return dict(ORACLES)
