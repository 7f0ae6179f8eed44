"""The star's nightly job: dimensions and facts written into their layers, gated across tables.

Dimensions are published first, each as a version. A fact is staged, then
judged against the dimensions *as published*: every foreign key must have its
dimension row (``fk_coverage``) and the grain must be unique. Only then the
fact's pointer moves; a lost key leaves the old fact in place. Verdicts are
kept like those of the loads. Staging models are views.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.plans import control
from starloom.plans.control import TableStore

DIMENSIONS, FACTS = "dimensions", "facts"
AT_ONCE = 4


@dataclass(frozen=True)
class Fact:
    """A fact's rows, its grain, and the published dimension (by name) behind every foreign key."""

    name: str
    rows: DataFrame
    grain: str
    keys: dict[str, str] = field(default_factory=dict)


def layer_of(layer: str, domain: str | None = None) -> str:
    """``dimensions``, or the twin layer of a domain (``dimensions_rh``)."""
    return f"{layer}_{domain}" if domain else layer


def stage_view(df: DataFrame, name: str) -> DataFrame:
    """A staging model: a view of the session, not a table."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def publish_dimension(store: TableStore, df: DataFrame, name: str, key: str = "id", domain: str | None = None) -> DataFrame:
    """Write and publish a dimension whose key must be unique and never NULL."""
    layer, run_id = layer_of(DIMENSIONS, domain), uuid.uuid4().hex
    path = store.stage(df, layer, name, run_id)
    staged = store.spark.read.schema(df.schema).parquet(path)
    per_key = staged.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    bad = per_key.agg(F.count_if(F.col("n") > 1).alias("repeated"), F.count_if(F.col(key).isNull()).alias("missing"))
    verdicts = bad.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("table_name"), F.lit(gate).alias("gate"), F.lit(key).alias("subject"), F.col(c).cast("double").alias("value"),
                 F.lit(0.0).alias("threshold"), F.when(F.col(c) > 0, "FAIL").otherwise("PASS").alias("status"))
        for gate, c in (("unique_key", "repeated"), ("null_key", "missing"))])))
    control.enforce(store, name, run_id, verdicts)
    store.publish(layer, name, path, run_id=run_id)
    return store.read(layer, name)


def fact_verdicts(staged: DataFrame, fact: Fact, dimensions: dict[str, DataFrame]) -> DataFrame:
    """One verdict per foreign key and one for the grain."""
    verdict = lambda gate, subject, value: [
        F.lit(fact.name).alias("table_name"), F.lit(gate).alias("gate"), subject.alias("subject"), value.cast("double").alias("value"),
        F.lit(0.0).alias("threshold"), F.when(value > 0, "FAIL").otherwise("PASS").alias("status")]
    grain = quality.grain_summary(staged, fact.grain, fact.name).select(*verdict("grain", F.lit(fact.grain), F.col("duplicate_keys")))
    if not fact.keys:
        return grain
    covered = quality.fk_coverage(staged, {fk: dimensions[name] for fk, name in fact.keys.items()})
    return grain.unionByName(covered.select(*verdict("fk_coverage", F.col("fk"), F.col("orphans"))))


def publish_fact(store: TableStore, fact: Fact, domain: str | None = None) -> DataFrame:
    """Stage → gates across tables → publish; raises ``DataQualityError`` and keeps the old fact when a gate fails."""
    layer, run_id = layer_of(FACTS, domain), uuid.uuid4().hex
    dimensions = {}
    for name in set(fact.keys.values()):
        dimensions[name] = store.read(layer_of(DIMENSIONS, domain), name)
        if dimensions[name] is None:
            raise ValueError(f"{fact.name}: dimension {name} is not published")
    path = store.stage(fact.rows, layer, fact.name, run_id)
    staged = store.spark.read.schema(fact.rows.schema).parquet(path)
    control.enforce(store, fact.name, run_id, fact_verdicts(staged, fact, dimensions))
    store.publish(layer, fact.name, path, run_id=run_id)
    return store.read(layer, fact.name)


def publish_star(store: TableStore, dimensions: dict[str, DataFrame], facts: list[Fact], domain: str | None = None) -> dict[str, DataFrame]:
    """All dimensions (some at a time), then all facts; returns the published facts by name."""
    with ThreadPoolExecutor(AT_ONCE) as pool:
        list(pool.map(lambda item: publish_dimension(store, item[1], item[0], domain=domain), dimensions.items()))
    return {f.name: publish_fact(store, f, domain) for f in facts}
