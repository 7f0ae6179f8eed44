"""Registered query for the streaming re-aim of incremental ingest (S1)."""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import functions as F

from starloom.plans.control import TableStore
from starloom.functions.keys import ts_lit
from starloom.registry import money, register
from starloom.sources.ingest import with_lineage
from starloom.sources.erp_fixture import ErpSources, oracle_with
from starloom.streaming.stream_upsert import stream_upsert

LANDING_SPLIT = dt.datetime(2001, 1, 1)
OVERLAP_FROM = dt.datetime(2000, 12, 1)
EXTRACT_1 = dt.datetime(2024, 2, 1, 2, 0)
EXTRACT_2 = dt.datetime(2024, 2, 2, 2, 0)


@register("stream_upsert", oracle_with(["src_sale_order"], [
    ("first_extract", f"""select id, name, state, cast(amount_untaxed as double) as amount_untaxed, create_date,
 timestamp '{EXTRACT_1}' as _extracted_at, 'erp_source' as _source_connection
 from src_sale_order where create_date < timestamp '{LANDING_SPLIT}'"""),
    ("second_extract", f"""select id, name, upper(state) as state, cast(amount_untaxed as double) as amount_untaxed,
 create_date, timestamp '{EXTRACT_2}' as _extracted_at, 'erp_source' as _source_connection
 from src_sale_order where create_date >= timestamp '{OVERLAP_FROM}'"""),
]) + """
select * from first_extract where id not in (select id from second_extract)
union all select * from second_extract""")
def q_stream_upsert(spark, sf_dir):
    """Two extracts of the sale orders (the second overlaps the first and
    changes the state) land as files; an ``availableNow`` stream upserts
    them batch by batch into a published table, which is returned."""
    src = ErpSources(spark, sf_dir).src_sale_order.select("id", "name", "state", "amount_untaxed", "create_date")
    store = TableStore(spark)
    run = uuid.uuid4().hex
    landing = os.path.join(store.root, "_landing", run)
    first = with_lineage(src.where(F.col("create_date") < ts_lit(LANDING_SPLIT)), EXTRACT_1, "erp_source")
    second = with_lineage(src.where(F.col("create_date") >= ts_lit(OVERLAP_FROM)).withColumn("state", F.upper("state")),
                          EXTRACT_2, "erp_source")
    first.write.parquet(os.path.join(landing, "part=1"))
    second.write.parquet(os.path.join(landing, "part=2"))
    # the extraction instant orders versions of a row: the later extract wins
    stream_upsert(spark, os.path.join(landing, "*"), first.schema, store, "raw", f"sale_order_stream_{run}",
                  key="id", order_col="_extracted_at", critical=["name"])
    out = store.read("raw", f"sale_order_stream_{run}")
    return money(out, ["amount_untaxed"])
