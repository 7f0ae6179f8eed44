"""Measures in a filter context: selections as values, kept or removed per measure.

A dashboard's slicers are a ``Context``: for each column the selected values,
listed or as a frame of values. A ``Measure`` says which of them it obeys:

* ``everything`` keeps all selections;
* ``removing("stage_id")`` drops the selection on a column, and the group it
  is shown in: a denominator over all stages beside each stage's numerator;
* ``only("vendor_id", ...)`` drops all selections but those, which reach the
  fact as selected values (a semi join), whatever table they were made on.

``evaluate`` compiles all measures of a fact into filtered aggregates of one
grouping: each measure is a sum over the rows its own selections let through.
Measures that remove a grouping column are summed over that column in a
window on the grouped rows, so the fact is read once whatever the number of
measures and contexts. Values must be additive (counts and sums).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starloom.plans.sizing import bounded_broadcast


@dataclass(frozen=True)
class Rule:
    """Which selections a measure obeys: all but ``removed``, or ``kept`` only."""

    removed: frozenset[str] = frozenset()
    kept: frozenset[str] | None = None

    def obeys(self, column: str) -> bool:
        return column not in self.removed and (self.kept is None or column in self.kept)


def everything() -> Rule:
    return Rule()


def removing(*columns: str) -> Rule:
    return Rule(removed=frozenset(columns))


def only(*columns: str) -> Rule:
    return Rule(kept=frozenset(columns))


@dataclass(frozen=True)
class Measure:
    """``value`` summed over the rows that pass ``where`` and the selections ``rule`` obeys."""

    name: str
    value: Column
    rule: Rule = field(default_factory=everything)
    where: Column | None = None


@dataclass(frozen=True)
class Context:
    """Selected values by column: an iterable of values, or a frame whose first column holds them."""

    selections: dict[str, Iterable | DataFrame]

    def apply(self, fact: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
        """``fact`` with a marker for every selection given as a frame, and a condition per selected column it has."""
        conditions: dict[str, Column] = {}
        for i, (column, chosen) in enumerate(self.selections.items()):
            if column not in fact.columns:
                continue  # no relation: the selection does not reach this fact
            if isinstance(chosen, DataFrame):
                values = chosen.select(F.col(chosen.columns[0]).alias(f"_v{i}")).where(F.col(f"_v{i}").isNotNull()).distinct()
                marked = bounded_broadcast(values.withColumn(f"_in{i}", F.lit(True)))
                fact = fact.join(marked, F.col(column) == F.col(f"_v{i}"), "left").drop(f"_v{i}")
                conditions[column] = F.col(f"_in{i}").isNotNull()
            else:
                conditions[column] = F.coalesce(F.col(column).isin(list(chosen)), F.lit(False))
        return fact, conditions


def evaluate(fact: DataFrame, context: Context, measures: list[Measure], by: list[str] = ()) -> DataFrame:
    """``by`` and one column per measure, for every group that some row of the context falls into."""
    by = list(by)
    marked, conditions = context.apply(fact)

    def passes(measure: Measure) -> Column:
        out = F.lit(True) if measure.where is None else F.coalesce(measure.where, F.lit(False))
        for column, condition in conditions.items():
            if measure.rule.obeys(column):
                out = out & condition
        return out

    shown = F.lit(True)
    for condition in conditions.values():
        shown = shown & condition
    sums = [F.sum(F.when(passes(m), m.value)).alias(m.name) for m in measures]
    grouped = marked.groupBy(*by).agg(*sums, F.count_if(shown).alias("_shown"))
    out = []
    for m in measures:
        rest = [c for c in by if c not in m.rule.removed and (m.rule.kept is None or c in m.rule.kept)]
        out.append(F.col(m.name) if rest == by else F.sum(m.name).over(Window.partitionBy(*rest)).alias(m.name))
    return grouped.select(*by, *out, "_shown").where("_shown > 0").drop("_shown")
