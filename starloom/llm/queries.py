"""Registered queries of the training-data operators, with DuckDB oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (decontaminate, embed_dedup, html_extract, importance, license_scan, minhash, mixing, packing, pii, quality, suffix_dedup, topk,
                          vector_codes)
from starloom.llm.common import table
from starloom.session import apply_core_conf

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_core_conf(spark)
        return fn(spark, sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@register
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes under repeated 400-byte strings removed from every document."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")


@register
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into 2,048-word sequences without two of one source or duplicate cluster."""
    return packing.pack(table(spark, sf_dir, "documents"))


@register
def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest integer inner products of every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@register
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.scan(table(spark, sf_dir, "documents"))


@register
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and passages in every document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at a cosine of 0.9 or more, and their components."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@register
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "size", "source_size", "target", "taken")


@register
def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at a shingle similarity of 0.75 or more, and their components."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_extract.extract(table(spark, sf_dir, "pages"))


@register
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the documents of 20 words or more, drawn towards the n-grams of the benchmark."""
    drawn = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


@register
def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that lie in a ten-word window of a benchmark item."""
    found = decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", decontaminate.items_digest().alias("items_sha256"), "contaminated")


@register
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen-part codes of all vectors, and their errors."""
    codes, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256"))


_COMPONENTS = """
reach as (
  select a as origin, a as other from nodes
  union
  select r.origin, l.b from reach r join links l on r.other = l.a
), component as (select origin, min(other) as component_id from reach group by origin)"""

ORACLES["op3_topk_search"] = """
with v as (
  select vec_id, row_number() over () as r, embedding from embeddings where embedding is not null
), parts as (
  select vec_id, r, unnest(embedding) as x, generate_subscripts(embedding, 1) as i from v
), valid as (
  select r from parts group by r having count(x) = count(*) and bool_and(coalesce(isfinite(x), false))
), ints as (
  select p.vec_id, p.r, p.i, cast(floor(1024 * cast(p.x as double)) as bigint) as x from parts p join valid using (r)
), scores as (
  select q.vec_id as query_id, c.vec_id, c.r, cast(sum(q.x * c.x) as bigint) as score
  from ints q join ints c on q.i = c.i and q.vec_id <> c.vec_id where q.vec_id % 100 = 0 group by all
), ranked as (
  select query_id, vec_id, score, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from scores
)
select query_id, rank, vec_id, score from ranked where rank <= 10"""

ORACLES["op6_embedding_dedup"] = f"""
with recursive parts as (
  select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as i from embeddings
), norms as (
  select vec_id, sqrt(sum(cast(x as double) * x)) as n from parts group by vec_id
  having count(x) = count(*) and bool_and(coalesce(isfinite(x), false)) and sum(abs(x)) > 0
), links as (
  select p.vec_id as a, q.vec_id as b from parts p join parts q on p.i = q.i and p.vec_id <> q.vec_id
  join norms m on m.vec_id = p.vec_id join norms n on n.vec_id = q.vec_id
  group by p.vec_id, q.vec_id, m.n, n.n having sum(cast(p.x as double) * q.x) / (m.n * n.n) >= 0.9
), nodes as (select vec_id as a from embeddings), {_COMPONENTS}, counted as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(k.n, 0) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join component c on c.origin = e.vec_id left join counted k on k.a = e.vec_id"""

ORACLES["op8_minhash_dedup"] = f"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws
  from documents
), places as (
  select doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) as i from w where len(ws) > 0
), shingles as (
  select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as s from places
), sizes as (select doc_id, count(*) as n from shingles group by doc_id), links as (
  select x.doc_id as a, y.doc_id as b from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id
  join sizes m on m.doc_id = x.doc_id join sizes n on n.doc_id = y.doc_id
  group by x.doc_id, y.doc_id, m.n, n.n having 100 * count(*) >= 75 * (m.n + n.n - count(*))
), nodes as (select doc_id as a from documents), {_COMPONENTS}
select d.doc_id, coalesce(z.n, 0) as n_shingles, c.component_id, d.doc_id = c.component_id as kept
from documents d join component c on c.origin = d.doc_id left join sizes z on z.doc_id = d.doc_id"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"coalesce(regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

ORACLES["op11_importance_resampling"] = f"""
with remainders as (
  select list(c order by b) as tab from (
    select b, list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, b) as c
    from (select unnest(range(256)) as b))
), texts as (
  select true as doc, row_number() over () as r, doc_id, {_WORDS} as ws from documents
  union all select false, row_number() over (), null, {_WORDS} from benchmark
), features as (
  select doc, r, unnest(ws) as f from texts
  union all select doc, r, ws[i] || ' ' || ws[i + 1] from (select doc, r, ws, unnest(range(1, len(ws))) as i from texts)
), kinds as (
  select f, hex(encode(f)) as h from (select distinct f from features)
), buckets as (
  select f, xor(list_reduce(list_transform(range(1, len(h), 2), lambda i: cast('0x' || substr(h, i, 2) as bigint)),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 as bucket from kinds, remainders
), counts as (
  select bucket, count(*) filter (doc) as s, count(*) filter (not doc) as t from features join buckets using (f) group by bucket
), totals as (
  select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from counts
), gains as (
  select bucket, cast(floor(1000 * ln(cast((t + 1) * (s_all + 10000) as double) / cast((s + 1) * (t_all + 10000) as double))) as bigint) as gain
  from counts, totals
), sums as (
  select r, count(*) as n, sum(gain) as g from features join buckets using (f) join gains using (bucket) where doc group by r
), scored as (
  select r, doc_id, len(ws) as n_words, coalesce(n, 0) as n_features, coalesce(cast(floor(cast(g as double) / n) as bigint), 0) as weight,
    cast('0x' || substr(sha256('7:' || doc_id), 1, 8) as bigint) as h from texts left join sums using (r) where doc
), final as (
  select *, weight + cast(floor(-1000 * ln(-ln((h + 0.5::double) / 4294967296::double))) as bigint) as score from scored
), ranked as (
  select r, row_number() over (order by score desc, doc_id) as rank, count(*) over () as n from final where n_words >= 20
)
select doc_id, n_features, weight, score, rank from final left join (select r, rank from ranked where rank <= 25 * n // 100) using (r)"""

ORACLES["op12_decontaminate"] = f"""
with items as (
  select distinct item_id, ws from (select item_id, {_WORDS} as ws from benchmark) where len(ws) > 0
), windows as (
  select distinct item_id, least(len(ws), 10) as k, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') as win
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) as i from items)
), texts as (
  select row_number() over () as r, doc_id, {_WORDS} as ws from documents
), places as (
  select r, i, k, array_to_string(ws[i:i + k - 1], ' ') as win
  from (select r, ws, unnest(range(1, len(ws) + 1)) as i from texts), (select distinct k from windows) where i + k - 1 <= len(ws)
), found as (
  select distinct r, i, k, item_id from places join windows using (k, win)
), hits as (
  select r, count(distinct w) as n_hit from (select distinct r, unnest(range(i, i + k)) as w from found) group by r
), ids as (
  select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids
  from found group by r
)
select doc_id, len(ws) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from texts left join hits using (r) left join ids using (r)"""


def _codebook_rounds(rounds: int) -> str:
    """CTEs ``near0, book1, near1, ...``: nearest entries (distance x 64 + entry, so that ties go to the lower), then floored means."""
    out = []
    for i in range(rounds + 1):
        out.append(f"""dist{i} as (
  select v.r, v.part, e, sum((v.x - b.x) * (v.x - b.x)) as d from comps v join book{i} b on v.part = b.part and v.pos = b.pos group by all
), near{i} as (
  select r, part, cast(min(d * 64 + e) as bigint) as best from dist{i} group by r, part
)""")
        if i < rounds:
            out.append(f"""sums{i} as (
  select v.part, v.pos, best % 64 as e, cast(sum(v.x) as bigint) as s, count(*) as n from comps v join near{i} using (r, part) group by all
), book{i + 1} as (
  select b.part, b.pos, b.e, coalesce((s - ((s % n) + n) % n) // n, b.x) as x from book{i} b left join sums{i} using (part, pos, e)
)""")
    return ", ".join(out)


ORACLES["op13_vector_codes"] = f"""
with numbered as (
  select row_number() over (order by vec_id) as r, vec_id, label, embedding from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
  select r, unnest(embedding) as x, generate_subscripts(embedding, 1) - 1 as i, len(embedding) // 16 as width from numbered
), comps as (
  select r, i // width as part, i % width as pos, cast(floor(256 * cast(x as double)) as bigint) as x from parts
), book0 as (
  select part, pos, r - 1 as e, x from comps where r <= 64
), {_codebook_rounds(2)}, codes as (
  select r, string_agg(lower(lpad(to_hex(best % 64), 2, '0')), '' order by part) as code, cast(sum(best // 64) as bigint) as error
  from near2 group by r
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error,
  (select sha256(string_agg(x, ',' order by part, e, pos)) from book2) as codebooks_sha256
from numbered join codes using (r)"""
