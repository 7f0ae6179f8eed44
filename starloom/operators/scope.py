"""Row-level security over a whole star: a filter on one table reaches every table that depends on it.

Relations point from a table's foreign key to the key of another table. A
filter on a table restricts every table that refers to it, and so on along
the relations: one semi join per relation, each against distinct keys. Tables
that do not depend on the filtered one are left as they are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.plans.sizing import bounded_broadcast


@dataclass(frozen=True)
class Relation:
    """``table.fk`` refers to ``parent.key``."""

    table: str
    fk: str
    parent: str
    key: str = "id"


# Relations of the star: which fact or dimension refers to which dimension.
STAR = [
    Relation("dim_vendor", "team_id", "dim_team"),
    Relation("fact_sale_order", "vendor_id", "dim_vendor"),
    Relation("fact_crm", "vendor_id", "dim_vendor"),
    Relation("fact_sale_order", "client_id", "dim_client"),
    Relation("fact_crm", "client_id", "dim_client"),
]


def scoped(tables: dict[str, DataFrame], root: str, allowed: Column, relations: list[Relation] = STAR) -> dict[str, DataFrame]:
    """``tables`` as a caller sees them who may see only the ``allowed`` rows of ``root``.

    A table that depends on a restricted one by several paths must satisfy
    all of them. Relations must not form a cycle.
    """
    out = dict(tables)
    out[root] = tables[root].where(F.coalesce(allowed, F.lit(False)))
    restricted, todo = {root}, [r for r in relations if r.table in tables and r.parent in tables]
    while todo:
        waiting = {r.table for r in todo}
        ready = [r for r in todo if r.parent not in waiting]
        if not ready:
            raise ValueError(f"relations form a cycle among {sorted(waiting)}")
        for r in ready:
            if r.parent in restricted:
                keys = out[r.parent].select(F.col(r.key).alias(r.fk)).distinct()
                out[r.table] = out[r.table].join(bounded_broadcast(keys), r.fk, "left_semi").select(*tables[r.table].columns)
                restricted.add(r.table)
        todo = [r for r in todo if r not in ready]
    return out


def vendor_scope_all(tables: dict[str, DataFrame], email: str, relations: list[Relation] = STAR) -> dict[str, DataFrame]:
    """All tables as the vendor with the caller's e-mail sees them."""
    return scoped(tables, "dim_vendor", F.lower(F.col("email")) == email.lower(), relations)
