"""Cleaning and schema-directed casting of extracted batches.

All work is column expressions over one ``select``: one pass, whole-stage
codegen, no Python per row. Casts never raise (``try_*``); what a cast
rejects is counted by ``cast_report`` instead.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Text tokens treated as missing, matched exactly.
NULL_TOKENS = ("nan", "None", "<NA>", "NaN", "")

_INTEGRAL_TEXT = r"^\s*[+-]?[0-9]+\s*$"


class ColumnCollisionError(ValueError):
    pass


def normalize_name(name: str) -> str:
    return name.replace(" ", "_").replace("-", "_").lower()


def normalize_names(df: DataFrame) -> DataFrame:
    """Spaces and ``-`` become ``_``, names become lower case; a collision raises."""
    new = [normalize_name(c) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ColumnCollisionError(f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    return df.toDF(*new)


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StructType, T.MapType, T.ArrayType))


def structs_to_json(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Nested columns (struct/map/array) as JSON text; NULL fields are kept."""
    targets = cols if cols is not None else [f.name for f in df.schema.fields if _is_nested(f.dataType)]
    opts = {"ignoreNullFields": "false"}
    return df.withColumns({c: F.to_json(F.col(c), opts) for c in targets})


def null_token(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)


def sanitize_strings(df: DataFrame) -> DataFrame:
    """Text columns: the tokens ``nan None <NA> NaN ''`` become NULL."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: null_token(c) for c in cols})


def finite(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    bad = F.isnan(c) | c.isin(float("inf"), float("-inf"))
    return F.when(bad, F.lit(None)).otherwise(c)


def sanitize_numbers(df: DataFrame) -> DataFrame:
    """Floating columns: ±inf and NaN become NULL (pandas treats NaN as missing)."""
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(c) for c in cols})


def sanitize(df: DataFrame) -> DataFrame:
    return sanitize_numbers(sanitize_strings(df))


# ------------------------------------------------------------------ casting

# Target type names as reported by the warehouse catalog.
TYPE_NAMES: dict[str, T.DataType] = {
    "smallint": T.ShortType(), "int2": T.ShortType(),
    "integer": T.IntegerType(), "int4": T.IntegerType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "int8": T.LongType(),
    "real": T.FloatType(), "float4": T.FloatType(),
    "double precision": T.DoubleType(), "float8": T.DoubleType(),
    "text": T.StringType(), "character varying": T.StringType(), "varchar": T.StringType(),
    "boolean": T.BooleanType(), "bool": T.BooleanType(),
    "timestamp": T.TimestampNTZType(), "timestamp without time zone": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(), "timestamp with time zone": T.TimestampType(),
    "date": T.DateType(),
    "json": T.StringType(), "jsonb": T.StringType(),
}


def spark_type(type_name: str) -> T.DataType:
    """Warehouse type name (``numeric(18,2)``, ``varchar(40)``, ``int8``...) → Spark type."""
    t = type_name.strip().lower()
    m = re.fullmatch(r"(?:numeric|decimal)\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?", t)
    if m:
        p = int(m.group(1) or 38)
        s = int(m.group(2) or (0 if m.group(1) else 18))
        return T.DecimalType(min(p, 38), s)
    if re.fullmatch(r"(?:varchar|character varying)\s*\(\s*\d+\s*\)", t):
        return T.StringType()
    if t.startswith("_") or t.endswith("[]"):
        return T.StringType()
    if t in TYPE_NAMES:
        return TYPE_NAMES[t]
    raise ValueError(f"unknown target type {type_name!r}")


def cast_expr(col: Column | str, target: T.DataType, source: T.DataType | None = None) -> Column:
    """Never-raising cast of one column to ``target``.

    Integers accept integral text only (``'12.5'`` is rejected, not rounded);
    text keeps NULL as NULL; JSON-ish nested values become JSON text.
    """
    c = F.col(col) if isinstance(col, str) else col
    if isinstance(target, T.StringType):
        if source is not None and _is_nested(source):
            return F.to_json(c, {"ignoreNullFields": "false"})
        return null_token(c.cast("string")) if isinstance(source, T.StringType) else c.cast("string")
    if isinstance(target, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        if source is None or isinstance(source, T.StringType):
            txt = F.trim(c.cast("string"))
            return F.when(txt.rlike(_INTEGRAL_TEXT), txt.try_cast(target))
        if isinstance(source, (T.DoubleType, T.FloatType, T.DecimalType)):
            return F.when(c == F.floor(c), c.try_cast(target))
        return c.try_cast(target)
    if isinstance(target, (T.DoubleType, T.FloatType)):
        return finite(c.try_cast(target))
    if isinstance(target, T.DecimalType):
        if isinstance(source, (T.DoubleType, T.FloatType)):
            return finite(c).try_cast(target)
        return c.try_cast(target)
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        if source is None or isinstance(source, T.StringType):
            return F.try_to_timestamp(F.trim(c.cast("string"))).try_cast(target)
        return c.try_cast(target)
    if isinstance(target, T.DateType):
        if source is None or isinstance(source, T.StringType):
            return F.try_to_date(F.trim(c.cast("string")), "yyyy-MM-dd")
        return c.try_cast(target)
    return c.try_cast(target)


def cast_to(df: DataFrame, target: dict[str, str | T.DataType]) -> tuple[DataFrame, DataFrame]:
    """Cast ``df`` to the target column types.

    Columns absent from ``df`` are skipped. Returns the cast frame and a lazy
    report frame (``column, target_type, rejected``): a rejected value is a
    non-NULL input that became NULL. The report is one aggregate pass.
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    plan = {c: (spark_type(t) if isinstance(t, str) else t) for c, t in target.items() if c in fields}
    out = df.withColumns({c: cast_expr(c, t, fields[c]).alias(c) for c, t in plan.items()})
    return out, cast_report(df, plan)


SEEN = "_seen_"


def cast_flagged(df: DataFrame, target: dict[str, str | T.DataType]) -> tuple[DataFrame, dict[str, tuple[str, str]]]:
    """Cast ``df`` and flag what is rejected, for one pass that casts, counts and writes.

    The frame has one boolean column ``_seen_<n>`` per cast column, true where
    a value was rejected; the second result maps its name to (column, type).
    """
    fields = {f.name: f.dataType for f in df.schema.fields}
    plan = {c: (spark_type(t) if isinstance(t, str) else t) for c, t in target.items() if c in fields}
    flags = {f"{SEEN}{i}": (c, t.simpleString()) for i, (c, t) in enumerate(plan.items())}
    rejected = [(F.col(c).isNotNull() & cast_expr(c, plan[c], fields[c]).isNull()).alias(n) for n, (c, _) in flags.items()]
    cast = [cast_expr(c, plan[c], fields[c]).alias(c) if c in plan else F.col(c) for c in df.columns]
    return df.select(*cast, *rejected), flags


def cast_report(df: DataFrame, plan: dict[str, T.DataType]) -> DataFrame:
    fields = {f.name: f.dataType for f in df.schema.fields}
    if not plan:
        return df.sparkSession.createDataFrame([], "column string, target_type string, rejected bigint")
    aggs = [
        F.count_if(F.col(c).isNotNull() & cast_expr(c, t, fields[c]).isNull()).alias(f"r{i}")
        for i, (c, t) in enumerate(plan.items())
    ]
    stack = ", ".join(f"'{c}', '{t.simpleString()}', r{i}" for i, (c, t) in enumerate(plan.items()))
    return df.agg(*aggs).selectExpr(f"stack({len(plan)}, {stack}) as (column, target_type, rejected)")
