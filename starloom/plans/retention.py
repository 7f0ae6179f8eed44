"""Clean-up of versions, stages and logs: mark what is named, sweep what is old.

Marked are: the version the pointer names and its open stage; the metrics of
runs on that version; staged batches of open runs; and anything younger than
the bound, which covers readers that still hold an older version and runs in
progress. A version's age counts from the moment another one replaced it, a
folder's that was never published from its last change. Everything else is
deleted, folder by folder.

Run logs keep their rows for ``control.LOG_RETENTION_DAYS`` and are rewritten
into one file per table; the old folders go only after the new one is whole.
A crash in between leaves rows twice, which reading by run id removes.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from starloom.plans import control, load, resume
from starloom.plans.control import META, TableStore

KEEP_HOURS = 72


class Folders:
    """Listing and deletion on whatever file system the tables live on."""

    def __init__(self, store: TableStore):
        context = store.spark.sparkContext
        self._path = context._jvm.org.apache.hadoop.fs.Path
        self._conf = context._jsc.hadoopConfiguration()

    def _fs(self, folder: str):
        path = self._path(folder)
        return path, path.getFileSystem(self._conf)

    def children(self, folder: str) -> list[tuple[str, str, dt.datetime]]:
        """``(name, path, last change)`` of the folders inside ``folder``."""
        path, fs = self._fs(folder)
        if not fs.exists(path):
            return []
        found = [(s.getPath().getName(), s.getPath().toString(), s.getModificationTime()) for s in fs.listStatus(path) if s.isDirectory()]
        return [(name, at, dt.datetime.fromtimestamp(ms / 1000, dt.timezone.utc).replace(tzinfo=None)) for name, at, ms in found]

    def delete(self, folder: str) -> None:
        path, fs = self._fs(folder)
        fs.delete(path, True)


def _tail(path: str, parts: int = 2) -> str:
    return "/".join(path.rstrip("/").split("/")[-parts:])


def sweep_table(store: TableStore, layer: str, table: str, now: dt.datetime, keep_hours: float = KEEP_HOURS) -> list[str]:
    """Delete what no pointer, open run or recent reader needs; returns the deleted folders."""
    folders, oldest = Folders(store), now - dt.timedelta(hours=keep_hours)
    base = f"{store.root}/{layer}/{table}"
    published = store.pointers(layer, table).orderBy("seq").collect()  # one row per publish
    live = published[-1] if published else None
    # a version's last moment is that of the first publish that names another one
    replaced: dict[str, dt.datetime] = {}
    for before, after in zip(published, published[1:]):
        if before["path"] != after["path"]:
            replaced[_tail(before["path"], 1)] = after["published_at"]
    named = set() if live is None else {_tail(live["path"], 1)}
    runs = set() if live is None else {p["run_id"] for p in published if p["path"] == live["path"]}
    still_open = resume.open_run(store, table)

    gone = []
    for name, path, changed in folders.children(base):
        if name.startswith("v=") and name not in named and replaced.get(name, changed) < oldest:
            gone.append(path)
    for name, path, changed in folders.children(f"{base}/_stage"):
        if (live is None or live["stage"] is None or _tail(live["stage"]) != f"_stage/{name}") and changed < oldest:
            gone.append(path)
    for name, path, changed in folders.children(f"{base}/_stats"):
        if name.removeprefix("run=") not in runs and changed < oldest:
            gone.append(path)
    for name, path, changed in folders.children(f"{store.root}/staging/{layer}/{table}"):
        if (still_open is None or name != f"v={still_open[0]}") and changed < oldest:
            gone.append(path)
    for path in gone:
        folders.delete(path)
    return gone


def compact_log(store: TableStore, name: str, schema, table: str, keep) -> int:
    """Rewrite the log ``name`` of one table into one folder holding the rows ``keep`` selects; returns folders merged.

    ``keep`` is a condition on the log's rows. A log of a single folder with
    nothing to drop is left alone.
    """
    folders = Folders(store)
    before = [path for _, path, _ in folders.children(f"{store.root}/{META}/{name}/{table}")]
    if not before:
        return 0
    rows = store.spark.read.schema(schema).parquet(*before).dropDuplicates()
    if len(before) == 1 and rows.where(~F.coalesce(keep, F.lit(False))).limit(1).count() == 0:
        return 0
    store.append(rows.where(keep).coalesce(1), META, name, table, f"kept-{uuid.uuid4().hex}")
    for path in before:
        folders.delete(path)
    return len(before)


def clean_up(store: TableStore, tables: list[tuple[str, str]], now: dt.datetime, keep_hours: float = KEEP_HOURS,
             log_days: int = control.LOG_RETENTION_DAYS) -> dict[str, list[str]]:
    """Sweep ``(layer, table)`` pairs and compact their logs; returns the deleted version and stage folders by table.

    Watermarks come from the log, so the rows from a table's last completed
    full load on are kept however old they are.
    """
    since = control.ts_lit(now - dt.timedelta(days=log_days))
    out = {}
    for layer, table in tables:
        out[f"{layer}.{table}"] = sweep_table(store, layer, table, now, keep_hours)
        full = (F.col("status") == "completed") & (F.col("extraction_type") == "full")
        last_full = load.read_log(store, table).agg(F.max(F.when(full, F.col("start_time")))).first()[0]
        needed = F.col("start_time") >= control.ts_lit(last_full) if last_full is not None else F.lit(True)
        compact_log(store, load.RUN_LOG, control.LOG_SCHEMA, table, (F.col("created_at") >= since) | needed)
        compact_log(store, control.GATE_HISTORY, control.GATE_SCHEMA, table, F.col("checked_at") >= since)
        closed = [r["run_id"] for r in resume.read_progress(store, table).where(
            (F.col("batch_no") == resume.WHOLE_RUN) & (F.col("status") != "started")).select("run_id").distinct().collect()]
        done = F.col("run_id").isin(closed)  # runs of one table within the retention
        compact_log(store, resume.PROGRESS, control.PROGRESS_SCHEMA, table, ~done | (F.col("updated_at") >= since))
        compact_log(store, resume.MANIFEST, control.MANIFEST_SCHEMA, table, ~done)
    return out
