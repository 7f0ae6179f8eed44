"""Near-duplicate vectors with hierarchical navigable small-world graphs, one graph per shard.

1. Rows with bitwise equal vectors form a class; one row of each is indexed,
   copies are counted and never compared.
2. Classes are dealt by hash into shards (at least ``MIN_SHARDS``, each of
   about ``SHARD_ROWS`` at most). Each shard's layered graph is built once, in
   batches: a batch is searched in the graph so far, then linked to diverse
   near neighbours. The finished graph is stored as one row.
3. All classes are queries, in blocks of ``QUERY_ROWS``; every block meets
   every shard: a graph is cogrouped with ``BLOCKS_TOGETHER`` blocks at a time,
   so it travels once for that many. A query's beam widens until it
   holds a row below the threshold, so large groups are found whole. Then a
   hashed share of the block's queries is compared with the whole shard; while
   the audited recall, a mean over queries taken apart by their number of links,
   is under ``RECALL`` for any size, all beams of the block widen and the search
   runs again, up to a beam as wide as the shard, which is exact.
4. Candidates are verified by cosine in double precision. A task returns the
   number of links of each query and a star forest of the linked vectors (one
   edge for each vector it linked), so a large group costs one row a vector.
5. Connected components of these edges, then classes back to rows.

Nothing but counts reaches the driver. Defined cases: null, empty and zero
vectors and vectors with null or non-finite components link with nothing, are
their own component and kept. Only vectors of equal length are compared. Rows
that repeat a vec_id are one vertex; each row is returned. A null vec_id gets
no links, a null component and is kept. Other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import mix, staged
from starloom.llm.graph import connected_components
from starloom.llm.vectors import matrix, usable

COSINE = 0.9
RECALL = 0.99
MIN_SHARDS = 8
SHARD_ROWS = 1 << 15
QUERY_ROWS = 1 << 13
BLOCKS_TOGETHER = 16  # query blocks that one copy of a graph serves
TASKS = 2048         # at most so many partitions of graphs and blocks
DEGREE = 12          # links of a vector in the upper layers; twice as many in the lowest
BUILD_BEAM = 48
BEAM = 32
TOGETHER = 256       # queries searched in step
EXPANDED = 4         # beam entries expanded in a step
AUDITS = 64          # at least so many audited queries of a block, and 1 in 64
FEW = 8              # at least AUDITS of the audited queries have fewer links than that, or are probes


class Graph:
    """A layered small-world graph over unit vectors."""

    def __init__(self, x: np.ndarray, degree: int = DEGREE, build_beam: int = BUILD_BEAM):
        self.x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        draw = (mix(np.arange(1, n + 1, dtype=np.uint64)) >> np.uint64(11)).astype(np.float64) / 2.0**53
        level = np.floor(-np.log(draw + 1e-12) / np.log(degree)).astype(int)
        self.layers: list[np.ndarray] = []  # highest first; neighbours of every vector, -1 where none
        self.top = np.zeros(0, np.int64)    # vectors of the highest layer, where every search starts
        present = np.zeros(0, np.int64)
        for lev in range(int(level.max(initial=0)), -1, -1):
            nodes = np.flatnonzero(level >= lev)
            if len(nodes) < 2 * degree and lev:
                continue
            width = degree if lev else 2 * degree
            links = np.full((n, width), -1, np.int32)
            if not len(self.top):
                self.top = present = nodes[: max(2 * degree, 64)]
            self._join(links, present, np.zeros((len(present), 0), np.int64), width)
            rest = np.setdiff1d(nodes, present, assume_unique=True)
            at, size = 0, len(present)
            while at < len(rest):
                batch = rest[at: at + max(16, min(TOGETHER, size))]
                entry = self._descend(self.x[batch])
                found, _ = self.beam(links, self.x[batch], entry, build_beam)
                self._join(links, batch, found, width)
                at, size = at + len(batch), size + len(batch)
            self.layers.append(links)
            present = nodes

    def _descend(self, q: np.ndarray, width: int = 4) -> np.ndarray:
        """Entry vectors for a search in the layer below the finished ones."""
        best = np.argsort(-(q @ self.x[self.top].T), axis=1, kind="stable")[:, :width]
        entry = self.top[best]
        for links in self.layers:
            entry, _ = self.beam(links, q, entry, 8)
            entry = entry[:, :width]
        return entry

    def beam(self, links: np.ndarray, q: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` most similar vectors met from ``entry``, best first (-1 where fewer)."""
        b, n = len(q), len(self.x)
        seen = np.zeros((b, n + 1), bool)
        seen[:, n] = True  # stands for "no vector"
        ids = np.full((b, width), n, np.int64)
        sims = np.full((b, width), -np.inf, np.float32)
        open_ = np.zeros((b, width), bool)
        rows, new = np.arange(b), np.where(entry < 0, n, entry)
        while len(rows):
            new = np.sort(new, axis=1)
            fresh = ~seen[rows[:, None], new]
            fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
            seen[rows[:, None], new] = True
            sim = np.full(new.shape, -np.inf, np.float32)
            r, c = np.nonzero(fresh)
            sim[r, c] = np.einsum("ij,ij->i", self.x[new[r, c]], q[rows[r]])
            all_sims = np.concatenate([sims[rows], sim], 1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            sims[rows] = np.take_along_axis(all_sims, order, 1)
            ids[rows] = np.take_along_axis(np.concatenate([ids[rows], np.where(fresh, new, n)], 1), order, 1)
            open_[rows] = np.take_along_axis(np.concatenate([open_[rows], fresh], 1), order, 1)
            # expand the best open entries of each query that has any
            place = np.cumsum(open_, axis=1)
            chosen = open_ & (place <= EXPANDED)
            rows = np.flatnonzero(chosen.any(1))
            picked = np.full((len(rows), EXPANDED), n, np.int64)
            r, c = np.nonzero(chosen[rows])
            picked[r, place[rows[r], c] - 1] = ids[rows[r], c]
            open_[rows] &= ~chosen[rows]
            near = np.where(picked[:, :, None] < n, links[np.minimum(picked, n - 1)], -1).reshape(len(rows), EXPANDED * links.shape[1])
            new = np.where(near < 0, n, near)
        return np.where(ids < n, ids, -1), sims

    def _join(self, links: np.ndarray, batch: np.ndarray, found: np.ndarray, width: int) -> None:
        """Link ``batch`` to diverse vectors among ``found`` and the batch itself, in both directions."""
        if not len(batch):
            return
        inner = self.x[batch] @ self.x[batch].T
        np.fill_diagonal(inner, -np.inf)
        near = np.argsort(-inner, axis=1, kind="stable")[:, : max(0, min(len(batch) - 1, 2 * width))]
        picked = self._diverse(batch, np.concatenate([found, batch[near]], 1), width)
        links[batch] = picked
        r, c = np.nonzero(picked >= 0)
        if not len(r):
            return
        source, target = batch[r], picked[r, c]
        order = np.lexsort((-np.einsum("ij,ij->i", self.x[source], self.x[target]), target))
        source, target = source[order], target[order]
        first = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        rank = np.arange(len(target)) - np.repeat(first, np.diff(np.append(first, len(target))))
        hit = target[first]
        incoming = np.full((len(hit), width), -1, np.int64)
        keep = rank < width
        incoming[np.searchsorted(hit, target[keep]), rank[keep]] = source[keep]
        links[hit] = self._diverse(hit, np.concatenate([links[hit], incoming], 1), width)

    def _diverse(self, owners: np.ndarray, near: np.ndarray, width: int) -> np.ndarray:
        """Up to ``width`` candidates for each owner: first those nearer to it than to one already taken, then the nearest."""
        out = np.full((len(owners), width), -1, np.int64)
        for lo in range(0, len(owners), TOGETHER):
            own, cand = owners[lo: lo + TOGETHER], np.sort(near[lo: lo + TOGETHER], axis=1)
            b, k = cand.shape
            bad = (cand < 0) | (cand == own[:, None])
            bad[:, 1:] |= cand[:, 1:] == cand[:, :-1]
            vectors = self.x[np.maximum(cand, 0)]
            sim = np.where(bad, -np.inf, np.einsum("bkd,bd->bk", vectors, self.x[own]))
            order = np.argsort(-sim, axis=1, kind="stable")[:, : 3 * width]
            cand, sim = np.take_along_axis(cand, order, 1), np.take_along_axis(sim, order, 1)
            vectors = np.take_along_axis(vectors, order[:, :, None], 1)
            cross = vectors @ vectors.transpose(0, 2, 1)
            real = sim > -np.inf
            taken = np.zeros(cand.shape, bool)
            for j in range(cand.shape[1]):
                nearest = np.where(taken, cross[:, j], -np.inf).max(1)
                taken[:, j] = real[:, j] & (sim[:, j] > nearest) & (taken.sum(1) < width // 2)
            score = np.where(real, sim + np.where(taken, 4.0, 0.0), -np.inf)
            best = np.argsort(-score, axis=1, kind="stable")[:, :width]
            ok = np.take_along_axis(score, best, 1) > -np.inf
            out[lo: lo + TOGETHER, : best.shape[1]] = np.where(ok, np.take_along_axis(cand, best, 1), -1)
        return out

    def search(self, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        return self.beam(self.layers[-1], q, self._descend_all(q), width)

    def _descend_all(self, q: np.ndarray) -> np.ndarray:
        layers, self.layers = self.layers, self.layers[:-1]
        try:
            return self._descend(q)
        finally:
            self.layers = layers

    def within(self, q: np.ndarray, threshold: float, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Parts of ``(query number, vector number)`` at ``threshold`` or more; beams widen while they are full of them.

        A beam that would hold a quarter of the shard is a scan of the shard instead.
        """
        n = len(self.x)
        for lo in range(0, len(q), TOGETHER):
            open_, beam = np.arange(lo, min(lo + TOGETHER, len(q))), width
            while len(open_):
                if 4 * beam >= n:
                    r, c = np.nonzero(q[open_] @ self.x.T >= threshold)
                    yield open_[r], c
                    break
                ids, sims = self.search(q[open_], beam)
                full = sims[:, -1] >= threshold
                r, c = np.nonzero((sims >= threshold) & ~full[:, None])
                yield open_[r], ids[r, c]
                open_, beam = open_[full], 4 * beam

    def probes(self, threshold: float, number: int) -> np.ndarray:
        """Queries with a known link: hashed vectors of the shard, each turned to just above the threshold."""
        n, dims = self.x.shape
        if dims < 2 or not 0 < threshold < 1:
            return self.x[:0]
        rank = mix(np.arange(n, dtype=np.uint64) + np.uint64(99))
        x = self.x[np.argsort(rank, kind="stable")[:number]].astype(np.float64)
        side = np.random.default_rng(n).standard_normal(x.shape)
        side -= np.einsum("ij,ij->i", side, x)[:, None] * x
        side /= np.linalg.norm(side, axis=1)[:, None] + 1e-12
        cosine = min(1.0, threshold + 1e-3)
        return (cosine * x + np.sqrt(1 - cosine * cosine) * side).astype(np.float32)

    def audited_width(self, q: np.ndarray, threshold: float, recall: float = RECALL, width: int = BEAM, own: np.ndarray | None = None) -> int:
        """The beam at which a hashed sample of the queries, compared with the whole shard, has the recall.

        Recall is the mean share of a query's links that are found, and has to be
        met by the queries of every size class (1, 2 to 3, 4 to 7, ... links).
        ``own`` is each query's place in the shard (-1: none), which is no link.
        While fewer than ``AUDITS`` sampled queries have under ``FEW`` links,
        probes with a known link are audited beside them.
        """
        if 4 * width >= len(self.x) or not len(q):
            return width
        n, rows = len(self.x), np.arange(len(q))
        picked = mix(rows.astype(np.uint64) + np.uint64(77)) % np.uint64(max(1, min(64, len(q) // AUDITS))) == 0
        sample, place = q[picked], np.full(int(picked.sum()), -1) if own is None else own[picked]

        def links(part: np.ndarray, at: np.ndarray) -> np.ndarray:
            pairs = [np.zeros(0, np.int64)]
            for lo in range(0, len(part), TOGETHER):
                near = part[lo: lo + TOGETHER] @ self.x.T >= threshold + 1e-6  # rounding decides nothing
                r, c = np.nonzero(near)
                r = r + lo
                pairs.append((r * n + c)[c != at[r]])
            return np.concatenate(pairs)

        exact = links(sample, place)
        number = np.bincount(exact // n, minlength=len(sample))
        missing = AUDITS - int(((number > 0) & (number < FEW)).sum())
        if missing > 0:
            more = self.probes(threshold, missing)
            sample, place = np.concatenate([sample, more]), np.append(place, np.full(len(more), -1))
            exact = links(sample, place)
            number = np.bincount(exact // n, minlength=len(sample))
        linked = np.flatnonzero(number)
        size = np.frexp(number[linked])[1]
        while 4 * width < n and len(linked):
            found = np.zeros(len(sample), np.int64)
            for r, c in self.within(sample, threshold, width):
                found += np.bincount(r[np.isin(r * n + c, exact)], minlength=len(sample))
            share = found[linked] / number[linked]
            if all(share[size == s].mean() >= recall for s in np.unique(size)):
                break
            width *= 2
        return width

    def to_bytes(self) -> bytes:
        """The links; the vectors are stored beside them."""
        out = io.BytesIO()
        np.savez(out, top=self.top, **{f"layer{i}": links for i, links in enumerate(self.layers)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, blob: bytes, x: np.ndarray) -> Graph:
        """The graph of the unit vectors ``x``."""
        graph, parts = cls.__new__(cls), np.load(io.BytesIO(blob), allow_pickle=False)
        graph.x, graph.top = np.ascontiguousarray(x, np.float32), parts["top"]
        graph.layers = [parts[f"layer{i}"] for i in range(len(parts.files) - 1)]
        return graph


def star_forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(vertex, smallest vertex it is connected with)`` over the edges (a, b)."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        least = np.minimum(label[x], label[y])
        new = label.copy()
        np.minimum.at(new, label[x], least)
        np.minimum.at(new, label[y], least)
        new = np.minimum(new, new[label])
        new = new[new]
        if (new == label).all():
            return nodes, nodes[label]
        label = new


def _build(kind: type):
    def run(shard: pa.Table) -> pa.Table:
        x = matrix(shard["values"], np.float64)
        order = np.argsort(shard["node"].to_numpy(), kind="stable")
        x = x[order]
        graph = Graph(x / np.linalg.norm(x, axis=1)[:, None])
        return pa.table({"shard": shard["shard"][:1], "graph": pa.array([graph.to_bytes()], pa.binary()),
                         "nodes": pa.array([shard["node"].to_numpy()[order]], pa.list_(pa.int64())),
                         "copies": pa.array([shard["copies"].to_numpy()[order]], pa.list_(pa.int64())),
                         "exact": pa.array([x.astype(kind).tobytes()], pa.binary())})

    return run


def _block(kind: type):
    def run(rows: pa.Table) -> pa.Table:
        return pa.table({"dims": rows["dims"][:1], "block": rows["block"][:1],
                         "asked": pa.array([rows["node"].to_numpy()], pa.list_(pa.int64())),
                         "vectors": pa.array([matrix(rows["values"], np.float64).astype(kind).tobytes()], pa.binary())})

    return run


def _links(cosine: float, recall: float, kind: type):
    def doubles(cell: pa.Scalar, rows: int) -> np.ndarray:
        return np.frombuffer(cell.as_buffer(), kind).reshape(rows, -1).astype(np.float64)

    def run(graphs: pa.Table, blocks: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(3)]
        if graphs.num_rows and blocks.num_rows:
            nodes, copies = (graphs[c][0].values.to_numpy() for c in ("nodes", "copies"))
            x = doubles(graphs["exact"][0], len(nodes))
            x_norm = np.linalg.norm(x, axis=1)
            graph = Graph.from_bytes(graphs["graph"][0].as_buffer(), x / x_norm[:, None])
        for i in range(blocks.num_rows if graphs.num_rows else 0):
            asked = blocks["asked"][i].values.to_numpy()
            q = doubles(blocks["vectors"][i], len(asked))
            q_norm = np.linalg.norm(q, axis=1)
            unit = np.ascontiguousarray(q / q_norm[:, None], np.float32)
            near = cosine - 1e-4  # single precision finds, double precision decides
            at = np.minimum(np.searchsorted(nodes, asked), len(nodes) - 1)
            width = graph.audited_width(unit, near, recall, own=np.where(nodes[at] == asked, at, -1))
            count = np.zeros(len(asked), np.int64)
            a = b = np.zeros(0, np.int64)
            for r, c in graph.within(unit, near, width):
                ok = np.einsum("ij,ij->i", q[r], x[c]) / (q_norm[r] * x_norm[c]) >= cosine
                ok &= asked[r] != nodes[c]
                r, c = r[ok], c[ok]
                count += np.bincount(r, copies[c], len(asked)).astype(np.int64)
                a, b = star_forest(np.concatenate([a, asked[r]]), np.concatenate([b, nodes[c]]))
            linked = np.flatnonzero(count)
            for column, parts in zip(out, ((asked[linked], a), (count[linked], np.zeros(len(a), np.int64)), (asked[linked], b))):
                column.extend(parts)
        return pa.table({name: pa.array(np.concatenate(column)) for name, column in zip(("node", "links", "root"), out)})

    return run


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding",
                    min_shards: int = MIN_SHARDS, shard_rows: int = SHARD_ROWS, query_rows: int = QUERY_ROWS,
                    blocks_together: int = BLOCKS_TOGETHER) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("values"))
    nonzero = F.exists("values", lambda x: x != 0)
    valid = usable("values") & nonzero & F.col("vec_id").isNotNull()
    classes = staged(rows.filter(valid).groupBy("values").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies")), "classes")
    sizes = {r.dims: r.n for r in classes.groupBy(F.size("values").alias("dims")).agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = spark.createDataFrame([(d, max(min_shards, -(-n // shard_rows)), max(1, -(-n // query_rows))) for d, n in sizes.items()],
                                 "dims int, shards long, blocks long")
    dealt = classes.withColumn("dims", F.size("values")).join(F.broadcast(plan), "dims").select(
        "node", "copies", "values", "dims", "shards", F.pmod(F.xxhash64("node"), "shards").alias("number"),
        F.pmod(F.xxhash64("node", F.lit(1)), "blocks").alias("block"))
    shard = F.col("dims").cast("long") * (1 << 32) + F.col("number")
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    kind = np.float32 if single else np.float64  # as stored; all cosines are taken in double precision
    graphs = staged(dealt.select(shard.alias("shard"), "node", "copies", "values").groupBy("shard").applyInArrow(
        _build(kind), "shard long, graph binary, nodes array<long>, copies array<long>, exact binary"), "graphs")
    blocks = staged(dealt.select("dims", "block", "node", "values").groupBy("dims", "block").applyInArrow(
        _block(kind), "dims int, block long, asked array<long>, vectors binary"), "blocks")
    # every (shard, part) has one copy of the graph and up to BLOCKS_TOGETHER blocks
    parts = plan.select("dims", F.ceil(F.col("blocks") / blocks_together).cast("long").alias("parts"))
    copied = graphs.withColumn("dims", F.shiftright("shard", 32).cast("int")).join(F.broadcast(parts), "dims").withColumn(
        "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select("shard", "part", "graph", "nodes", "copies", "exact")
    spread = blocks.join(F.broadcast(plan.select("dims", "shards").join(parts, "dims")), "dims").withColumn(
        "number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1))).select(
            shard.alias("shard"), F.pmod("block", "parts").alias("part"), "asked", "vectors")
    tasks = min(TASKS, max(1, 2 * sum(max(min_shards, -(-n // shard_rows)) * -(-n // (query_rows * blocks_together)) for n in sizes.values())))
    found = staged(copied.repartition(tasks, "shard", "part").groupBy("shard", "part").cogroup(
        spread.repartition(tasks, "shard", "part").groupBy("shard", "part")).applyInArrow(
            _links(cosine, recall, kind), "node long, links long, root long"), "links")
    counted = found.groupBy("node").agg(F.sum("links").alias("links"))
    same_id = rows.filter(valid).join(classes.select("values", "node"), "values").filter("vec_id <> node").select(
        F.col("vec_id").alias("u"), F.col("node").alias("v"))
    label = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(same_id))
    per_class = classes.join(counted, "node", "left").select(
        "values", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return (rows.withColumn("valid", valid).join(per_class.withColumn("valid", F.lit(True)), ["valid", "values"], "left")
            .join(label.select(F.col("id").alias("vec_id"), "component"), "vec_id", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))
