"""Key-based upsert (insert new ids, overwrite existing ones) and its counts.

Plain Parquet has no MERGE, so the merged rows are computed: an update keeps
the target columns the delta does not carry, an insert leaves them NULL. A
delta whose plan statistics are small is broadcast and only probed, so the
target is not shuffled (``target ▷ delta`` ∪ delta); any other is merged in one
full outer join that reads each side once. ``merge`` also tells what happened
to every row. Which part of a table is merged at all is decided by
``plans.buckets``: only the hash buckets the delta touches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.clean import cast_expr
from starloom.plans.sizing import BROADCAST_BYTES, plan_bytes


class DeltaKeyError(ValueError):
    """NULL or duplicate keys left in a delta after latest-wins dedup."""


def latest_per_key(delta: DataFrame, key: str, order_col: str | None) -> DataFrame:
    """Latest row per key by ``order_col``; ties broken by the rest of the row.

    ``max(struct(order_col, ...))`` is a partial aggregate: each map task
    reduces its rows per key before the shuffle, so a key holding a third
    of the delta still moves one row per task. Without ``order_col`` nothing
    says which of two rows is the latest: a repeated key fails the job.
    """
    rest = [c for c in delta.columns if c not in (key, order_col)]
    if order_col is None:
        row = F.any_value(F.struct(*rest)).alias("_best") if rest else F.lit(None).alias("_best")
        one = delta.groupBy(key).agg(row, F.count(F.lit(1)).alias("_n"))
        repeated = F.concat(F.lit(f"duplicate keys in a delta without order column: {key} = "), F.coalesce(F.col(key).cast("string"), F.lit("NULL")))
        one = one.where(F.when(F.col("_n") > 1, F.raise_error(repeated).cast("boolean")).otherwise(F.lit(True)))
        return (one.select(key, "_best.*") if rest else one).select(*delta.columns)
    best = F.max(F.struct(F.col(order_col).alias(order_col), *[F.col(c) for c in rest])).alias("_best")
    return delta.groupBy(key).agg(best).select(key, "_best.*").select(*delta.columns)


def align_to(delta: DataFrame, target: DataFrame) -> DataFrame:
    """Delta columns matched to the target by name and cast to its types.

    Columns the target lacks are kept with their own type (see ``widen``);
    columns are never matched by position.
    """
    tf = {f.name: f.dataType for f in target.schema.fields}
    df_ = {f.name: f.dataType for f in delta.schema.fields}
    return delta.select(*[(cast_expr(c, tf[c], df_[c]) if tf.get(c, df_[c]) != df_[c] else F.col(c)).alias(c)
                          for c in delta.columns])


def widen(target: DataFrame, delta: DataFrame) -> DataFrame:
    """Target plus the columns only the delta has (NULL for the rows so far)."""
    new = [f for f in delta.schema.fields if f.name not in target.columns]
    return target.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in new]) if new else target


OP = "_op"


def merge(target: DataFrame, delta: DataFrame, key: str = "id", also: list[str] = ()) -> DataFrame:
    """Target and delta (one row per key) merged in one full outer join, plus ``_op``.

    ``_op`` is ``insert``, ``update`` or NULL (untouched). ``also`` names columns
    that both sides share for equal keys (a bucket number); they join too.
    Target rows without a key match nothing and are spread by their content.
    """
    target = widen(target, delta)
    d = align_to(delta, target)
    loose = F.when(F.col(key).isNull(), F.xxhash64(F.to_json(F.struct("*"))))
    t = target.withColumns({"_t": F.lit(True), "_loose": F.coalesce(loose, F.lit(0))}).alias("t")
    n = d.withColumns({"_d": F.lit(True), "_loose": F.lit(0).cast("bigint")}).alias("d")
    on = F.col("t._loose") == F.col("d._loose")
    for c in [key, *also]:
        on = on & (F.col(f"t.`{c}`") == F.col(f"d.`{c}`"))
    new = F.col("d._d").isNotNull()
    columns = [(F.when(new, F.col(f"d.`{c}`")).otherwise(F.col(f"t.`{c}`")) if c in d.columns else F.col(f"t.`{c}`")).alias(c)
               for c in target.columns]
    op = F.when(new & F.col("t._t").isNotNull(), F.lit("update")).when(new, F.lit("insert")).alias(OP)
    return t.join(n, on, "full_outer").select(*columns, op)


def upsert(target: DataFrame, delta: DataFrame, key: str = "id", order_col: str | None = None,
           broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Merged table: untouched target rows + delta rows.

    The schema is the target's plus any column only the delta has (NULL in
    untouched rows), so a column added at the source reaches the table. A
    delta bounded by ``broadcast_bytes`` (plan statistics, no job) is
    broadcast, so the target is filtered by hash lookups in place and never
    shuffled; a larger one takes ``merge``.
    """
    d = latest_per_key(delta, key, order_col)
    if plan_bytes(delta) > broadcast_bytes:
        return merge(target, d, key).drop(OP)
    target = widen(target, d)
    d = align_to(d, target)
    d_keys = F.broadcast(d.select(key))
    kept = target.join(d_keys, key, "left_anti")
    missing = [c for c in target.columns if c not in d.columns]
    if missing:
        # columns the batch does not carry: keep the target's value on update
        prev = target.join(d_keys, key, "left_semi").select(key, *missing)
        d = d.join(prev, key, "left")
    return kept.unionByName(d.select(*target.columns))


def upsert_counts(target: DataFrame, delta: DataFrame, key: str = "id", order_col: str | None = None,
                  broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row: ``inserts`` (delta keys new to the target) and ``updates``."""
    d_keys = delta.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).select(key)
    # probe the target with the delta keys as the build side where their size is bounded
    probe = F.broadcast(d_keys) if plan_bytes(delta) <= broadcast_bytes else d_keys
    hit = target.select(key).join(probe, key, "left_semi").distinct()
    updates = hit.agg(F.count(F.lit(1))).scalar()
    return d_keys.agg(F.count(F.lit(1)).alias("delta_keys")).select(
        (F.col("delta_keys") - updates).alias("inserts"), updates.alias("updates"))


def check_delta_keys(delta: DataFrame, key: str = "id") -> DataFrame:
    """One row: NULL keys and keys occurring more than once (both must be 0)."""
    per = delta.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("null_keys"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("duplicate_keys"),
    )


def assert_delta_keys(delta: DataFrame, key: str = "id") -> None:
    row = check_delta_keys(delta, key).first()
    if row["null_keys"] or row["duplicate_keys"]:
        raise DeltaKeyError(f"delta has {row['null_keys']} NULL and {row['duplicate_keys']} duplicate keys")


def append_rows(target: DataFrame, batch: DataFrame) -> DataFrame:
    """Append by column name; a column that only one side has is NULL in the other's rows."""
    return widen(target, batch).unionByName(align_to(batch, target), allowMissingColumns=True)
