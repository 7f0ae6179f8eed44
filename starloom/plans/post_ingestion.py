"""The job after the loads: report, statistics, freshness, clean-up.

It reads published tables and stored logs only, and runs whether loads failed
or not: a table that cannot be read is an ERROR row of the report, and no part
keeps another from running. Nothing here blocks a load.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.utils import AnalysisException

from starloom.operators import quality
from starloom.plans import control, load, retention
from starloom.plans.control import TableStore


@dataclass
class AfterIngestion:
    """What the job found; ``failures`` names parts that raised."""

    report: DataFrame | None = None
    stats: DataFrame | None = None
    freshness: DataFrame | None = None
    deleted: dict[str, list[str]] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def published_frames(store: TableStore, tables: list[tuple[str, str]]) -> dict[str, DataFrame | None]:
    out: dict[str, DataFrame | None] = {}
    for layer, table in tables:
        try:
            out[table] = store.read(layer, table)
        except AnalysisException:  # its files are gone: an ERROR row of the report
            out[table] = None
    return out


def after_ingestion(store: TableStore, tables: list[tuple[str, str]], now: dt.datetime, id_col: str = "id",
                    keep_hours: float = retention.KEEP_HOURS) -> AfterIngestion:
    """Run all parts over the published ``(layer, table)`` pairs and their logs."""
    out = AfterIngestion()
    parts = {
        "report": lambda: quality.quality_report(published_frames(store, tables), id_col),
        "stats": lambda: quality.extraction_stats(load.read_log(store), now),
        "freshness": lambda: quality.gate_freshness(load.read_watermarks(store), now),
        "deleted": lambda: retention.clean_up(store, tables, now, keep_hours),
    }
    for name, run in parts.items():
        try:
            setattr(out, name, run())
        except Exception as error:  # noqa: BLE001 - every part runs; what failed is reported
            out.failures[name] = str(error)
    return out
