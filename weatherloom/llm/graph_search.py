"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt into shards of bounded size. Each shard has a graph: points are
added in growing batches, a greedy search from the shard's centre proposes
neighbours for all points of a batch side by side, and pruning keeps an edge only
if no kept neighbour is clearly nearer to its end (factor ``ALPHA``), so edges
point in different directions. Edges are also added backward and pruned again.
Blocks of queries search every shard with a beam; the results are merged. A search
starts from the nearest of many spread points, so a large group near one of them
cannot fill the beam alone, and points that no edge leads to get an edge of their own.

Nearness is the inner product. The graph is built on Euclidean distances after
one more coordinate makes all norms equal, which keeps the order of inner products.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weatherloom.llm.shipping import ship
from weatherloom.llm.scratch import materialise

SHARD = 4_096
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 96
ALPHA = 1.2
# searches start from the nearest of every ENTRY_STEP-th point and FAR_ENTRIES spread ones
ENTRY_STEP = 8
FAR_ENTRIES = 64
QUERY_BLOCK = 1_024
# of a build or a search; more groups of work share tasks
MOST_TASKS = 10_000
NEAREST = 20


def nearest(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
    count: int = NEAREST, shard: int = SHARD, beam: int = SEARCH_BEAM,
) -> DataFrame:
    """(query_id, rank, id, score): the ``count`` largest inner products found.

    Rows with ``is_query`` are the queries and search all other rows; fewer rows
    come out where there are fewer candidates. Scores are inner products of the
    given vectors in double precision; ties go to the smaller id. Vectors that are
    null, empty or zero, or that hold nulls, NaN or infinities, take no part, nor do
    null ids; vectors of different length are never compared. Of rows that repeat an
    id, each is a candidate to other ids, and each query row of the id asks once.

    Equal vectors are one point of the index, with the ``count`` + 1 smallest distinct
    ids and the rows of each, since no query can return more of them.
    """
    ship(vectors.sparkSession)
    clean = materialise(_usable(vectors, is_query, id_col, vector_col), "vectors")
    points = _points(clean, count)
    shape = points.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("norm"))
    shards = F.greatest(F.lit(1), F.ceil(F.col("n") / shard)).cast("int")
    shape = materialise(shape.select("dim", "norm", shards.alias("shards")), "shape")
    index = _index(points, shape)
    blocks, many = _blocks(clean, shape)
    found = _search(index, blocks, many, count, beam)
    best = Window.partitionBy("query_id", "ask").orderBy(F.desc("score"), "id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= count)
        .select("query_id", "rank", F.col("id").alias(id_col), "score")
    )


def _usable(vectors, is_query, id_col, vector_col):
    v = F.col("vector")
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    )
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    rows = rows.where(F.col("id").isNotNull() & v.isNotNull()).where(~F.exists(v, bad))
    return rows.where(F.exists(v, lambda x: x != 0)).withColumn("dim", F.size("vector"))


def _points(clean, count):
    """Distinct vectors with their smallest ids.

    Rows that repeat an id are counted first, with a partial step; of a query's result
    one id fills at most all ``count`` places. The rank limit is applied before its
    shuffle as well, so of a group of copies each task sends ``count`` + 1 ids.
    """
    # -0.0 and 0.0 are equal
    plain = F.transform("vector", lambda x: x + F.lit(0.0)).alias("vector")
    same = ["dim", "key", "vector"]
    rows = clean.select("dim", "id", plain).withColumn("key", F.xxhash64("vector"))
    named = rows.groupBy(*same, "id").agg(F.count("*").alias("rows"))
    rank = F.row_number().over(Window.partitionBy(*same).orderBy("id"))
    kept = named.withColumn("rank", rank).where(F.col("rank") <= count + 1)
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    points = kept.groupBy(*same).agg(F.sort_array(F.collect_list(F.struct("id", "rows"))).alias("named"))
    ids = F.flatten(F.transform("named", lambda i: F.array_repeat(i["id"], F.least(i["rows"], F.lit(count)).cast("int"))))
    return materialise(points.select(*same, ids.alias("ids"), norm.alias("norm")), "points")


def _index(points, shape):
    """One row for each shard: vectors, ids and graph."""
    # a few stored rows, one for each length of vectors: Spark broadcasts them by their size
    dealt = points.join(shape, "dim")
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(1)), F.col("shards")).cast("int"))
    # dim and norm are the key's and the same in the whole group
    inputs = dealt.select("dim", "shard", F.struct("key", "vector", "ids", shape["norm"].alias("most")).alias("p"))

    def build(table: pa.Table) -> pa.Table:
        rows = table.column("p").combine_chunks()
        order = np.argsort(rows.field("key").to_numpy(), kind="stable")
        x = np.array(rows.field("vector").to_pylist(), dtype=np.float64)[order]
        ids = [rows.field("ids")[int(i)].as_py() for i in order]
        most = rows.field("most")[0].as_py()
        graph, entries = build_graph(with_equal_norms(x, most))
        return pa.table(
            {
                "dim": table.column("dim").slice(0, 1),
                "shard": table.column("shard").slice(0, 1),
                "vectors": [x.tobytes()],
                "ids": [np.array([i for group in ids for i in group], dtype=np.int64).tobytes()],
                "sizes": [np.array([len(group) for group in ids], dtype=np.int32).tobytes()],
                "graph": [graph.tobytes()],
                "entries": [entries.astype(np.int32).tobytes()],
            }
        )

    schema = "dim int, shard int, vectors binary, ids binary, sizes binary, graph binary, entries binary"
    inputs = inputs.repartition(_tasks(shape.select("shards")), "dim", "shard")
    return materialise(inputs.groupBy("dim", "shard").applyInArrow(build, schema), "index")


def _tasks(counts):
    """One task for each group of work, however few bytes it has, up to ``MOST_TASKS``."""
    return max(1, min(MOST_TASKS, counts.select(F.sum(F.col(counts.columns[0]).cast("long"))).first()[0] or 1))


def _blocks(clean, shape):
    """Queries packed by hash into blocks; one row for each block."""
    asks = clean.where("asks").select("dim", "id", "vector")
    n = asks.groupBy("dim").agg(F.ceil(F.count("*") / QUERY_BLOCK).cast("int").alias("blocks"))
    n = materialise(n, "block-counts")
    dealt = asks.join(n, "dim")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("vector", "id"), F.col("blocks")).cast("int"))

    def pack(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("id").to_numpy(), kind="stable")
        x = np.array(table.column("vector").to_pylist(), dtype=np.float64)[order]
        return pa.table(
            {
                "dim": table.column("dim").slice(0, 1),
                "block": table.column("block").slice(0, 1),
                "query_ids": [table.column("id").to_numpy()[order].tobytes()],
                "queries": [x.tobytes()],
            }
        )

    packed = dealt.groupBy("dim", "block").applyInArrow(
        pack, "dim int, block int, query_ids binary, queries binary"
    )
    return materialise(packed.join(shape, "dim"), "blocks"), n


def _search(index, blocks, many, count, beam):
    """Every block of queries meets every shard of its dimension once."""
    asked = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    shards = index.join(many, "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    )
    keys = ["dim", "shard", "block"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            row = {name: left.column(name)[0].as_py() for name in left.column_names}
            ask = {name: right.column(name)[0].as_py() for name in right.column_names}
            out.append(_found(row, ask, count, beam))
        empty = pa.schema([("query_id", pa.int64()), ("ask", pa.int32()), ("id", pa.int64()), ("score", pa.float64())])
        return pa.concat_tables(out) if out else empty.empty_table()

    tasks = _tasks(blocks.select("shards"))
    left = shards.select(*keys, "vectors", "ids", "sizes", "graph", "entries").repartition(tasks, *keys)
    right = asked.select(*keys, "query_ids", "queries").repartition(tasks, *keys)
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        search, "query_id long, ask int, id long, score double"
    )


def _found(row, ask, count, beam):
    x = np.frombuffer(row["vectors"]).reshape(-1, row["dim"])
    graph = np.frombuffer(row["graph"], dtype=np.int32).reshape(len(x), -1)
    entries = np.frombuffer(row["entries"], dtype=np.int32).astype(np.int64)
    sizes, ids = np.frombuffer(row["sizes"], dtype=np.int32), np.frombuffer(row["ids"], dtype=np.int64)
    first = np.cumsum(sizes) - sizes
    query_ids = np.frombuffer(ask["query_ids"], dtype=np.int64)
    queries = np.frombuffer(ask["queries"]).reshape(-1, row["dim"])
    near = np.full((len(queries), max(beam, count + 1)), -1, dtype=np.int64)
    for begin in range(0, len(queries), 256):
        part = queries[begin : begin + 256]
        point, _ = beam_search(x.astype(np.float32), graph, entries, part.astype(np.float32), near.shape[1], inner=True)
        near[begin : begin + 256, : point.shape[1]] = point
    q, place = np.nonzero(near >= 0)
    point = near[q, place]
    score = np.einsum("ij,ij->i", queries[q], x[point])
    # every point stands for the ids of equal vectors
    many = sizes[point]
    at = np.repeat(first[point] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    q, score, found = np.repeat(q, many), np.repeat(score, many), ids[at]
    other = found != query_ids[q]
    q, score, found = q[other], score[other], found[other]
    order = np.lexsort((found, -score, q))
    q, score, found = q[order], score[order], found[order]
    start = np.searchsorted(q, np.arange(len(queries)))
    top = np.arange(len(q)) - start[q] < count
    # query rows that repeat an id are told apart by their number
    again = np.arange(len(query_ids)) - np.searchsorted(query_ids, query_ids)
    return pa.table(
        {
            "query_id": query_ids[q[top]],
            "ask": again[q[top]].astype(np.int32),
            "id": found[top],
            "score": score[top],
        }
    )


def with_equal_norms(x: np.ndarray, most: float) -> np.ndarray:
    last = np.sqrt(np.maximum(most**2 - (x**2).sum(axis=1), 0))
    return np.concatenate([x, last[:, None]], axis=1).astype(np.float32)


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA):
    """Neighbour numbers (-1: none), one line for each point, and the points to start from.

    Every point can be reached; a line is longer than ``degree`` where that takes edges.
    """
    n = len(x)
    entry = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    graph = np.full((n, degree), -1, dtype=np.int32)
    order = np.random.default_rng(5).permutation(n)
    order = np.concatenate([[entry], order[order != entry]])
    done = min(n, 2 * degree)
    # the first points are few enough to be pruned from all of their number
    first = order[:done]
    candidates = np.broadcast_to(first, (done, done))
    graph[first] = prune(x, first, candidates, degree, alpha)
    while done < n:
        batch = order[done : done + min(max(done // 2, 64), 512)]
        found, visited = beam_search(x, graph, order[: -(-done // ENTRY_STEP)], x[batch], beam)
        graph[batch] = prune(x, batch, np.concatenate([found, visited], axis=1), degree, alpha)
        _link_back(x, graph, batch, degree, alpha)
        done += len(batch)
    entries = np.union1d(order[: -(-n // ENTRY_STEP)], _far_points(x, entry, FAR_ENTRIES))
    return _reachable(x, graph, entries), entries


def _far_points(x, start, count):
    """Up to ``count`` points, each the one farthest from those before it."""
    out = [start]
    d = ((x - x[start]) ** 2).sum(axis=1)
    while len(out) < count and d.max() > 0:
        out.append(int(d.argmax()))
        d = np.minimum(d, ((x - x[out[-1]]) ** 2).sum(axis=1))
    return np.array(out)


def _spread_from(graph, points, reached):
    """Mark all that edges lead to from ``points``; the points newly marked."""
    new = [points]
    reached[points] = True
    while len(points):
        near = np.unique(graph[points])
        near = near[near >= 0]
        points = near[~reached[near]]
        reached[points] = True
        new.append(points)
    return np.concatenate(new)


def _reachable(x, graph, entries):
    """The graph with an edge from a reached point to the nearest unreached one, until none is left."""
    reached = np.zeros(len(x), dtype=bool)
    new = _spread_from(graph, entries, reached)
    near = np.full(len(x), np.inf)
    owner = np.zeros(len(x), dtype=np.int64)
    extra = {}
    while not reached.all():
        rest = np.flatnonzero(~reached)
        for begin in range(0, len(new), 128):
            some = new[begin : begin + 128]
            d = np.stack([((x[rest] - x[p]) ** 2).sum(axis=1) for p in some])
            best = d.argmin(axis=0)
            d = d[best, np.arange(len(rest))]
            closer = d < near[rest]
            near[rest[closer]], owner[rest[closer]] = d[closer], some[best[closer]]
        point = int(rest[near[rest].argmin()])
        extra.setdefault(int(owner[point]), []).append(point)
        new = _spread_from(graph, np.array([point]), reached)
    more = np.full((len(x), max(map(len, extra.values()), default=0)), -1, dtype=np.int32)
    for source, targets in extra.items():
        more[source, : len(targets)] = targets
    return np.concatenate([graph, more], axis=1)


def _link_back(x, graph, batch, degree, alpha):
    source = np.repeat(batch, degree)
    target = graph[batch].ravel()
    real = target >= 0
    source, target = source[real], target[real]
    order = np.argsort(target, kind="stable")
    source, target = source[order], target[order]
    owners, first, many = np.unique(target, return_index=True, return_counts=True)
    # a popular point may get many new edges at once; its own list stays in front
    for begin in range(0, len(owners), 1024):
        some = slice(begin, begin + 1024)
        wide = int(many[some].max())
        at = first[some, None] + np.arange(wide)
        fresh = np.where(np.arange(wide) < many[some, None], source[np.minimum(at, len(source) - 1)], -1)
        joined = np.concatenate([graph[owners[some]], fresh], axis=1)
        room = (joined >= 0).sum(axis=1) <= degree
        packed = np.take_along_axis(joined, np.argsort(joined < 0, axis=1, kind="stable"), axis=1)
        graph[owners[some][room]] = packed[room][:, :degree]
        full = np.flatnonzero(~room)
        graph[owners[some][full]] = prune(x, owners[some][full], joined[full], degree, alpha)


def prune(x, points, candidates, degree, alpha):
    """Of each point's candidates, nearest first, those no kept one is clearly nearer to."""
    out = np.full((len(points), degree), -1, dtype=np.int32)
    for begin in range(0, len(points), 128):
        some = points[begin : begin + 128]
        c = candidates[begin : begin + 128].astype(np.int64)
        real = (c >= 0) & (c != some[:, None])
        d = ((x[np.maximum(c, 0)] - x[some][:, None]) ** 2).sum(axis=2)
        d = np.where(real, d, np.inf)
        order = np.lexsort((c, d), axis=1)
        c, d = np.take_along_axis(c, order, 1), np.take_along_axis(d, order, 1)
        d[:, 1:][c[:, 1:] == c[:, :-1]] = np.inf  # proposed twice
        rows = np.arange(len(some))
        for k in range(degree):
            best = d.argmin(axis=1)
            alive = np.isfinite(d[rows, best])
            if not alive.any():
                break
            chosen = c[rows, best]
            out[begin : begin + 128][alive, k] = chosen[alive]
            apart = ((x[np.maximum(c, 0)] - x[chosen][:, None]) ** 2).sum(axis=2)
            d[alpha**2 * apart <= d] = np.inf
            d[rows, best] = np.inf
    return out


def beam_search(x, graph, entry, queries, beam, inner=False):
    """The ``beam`` nearest points met by each query, and the points it opened.

    ``entry`` is one point or several, of which each query starts from its nearest.
    All queries take one step at a time: each opens its nearest unopened point,
    whose neighbours enter the beam. A query ends when its whole beam is opened.
    """
    n = len(queries)
    far = np.float32(np.inf)

    def distance(q, points):
        y = x[points]
        if inner:
            return -np.einsum("qkd,qd->qk", y, q)
        return ((y - q[:, None]) ** 2).sum(axis=2)

    ids = np.full((n, beam), -1, dtype=np.int64)
    dist = np.full((n, beam), far, dtype=np.float32)
    opened = np.ones((n, beam), dtype=bool)
    entry = np.atleast_1d(entry)
    many = min(beam, len(entry))
    for begin in range(0, n, 32):
        some = slice(begin, begin + 32)
        d = distance(queries[some], np.broadcast_to(entry, (len(queries[some]), len(entry))))
        best = np.argpartition(d, many - 1, axis=1)[:, :many]
        ids[some, :many] = entry[best]
        dist[some, :many] = np.take_along_axis(d, best, 1)
    opened[:, :many] = False
    seen = np.zeros((n, len(x)), dtype=bool)
    seen[:, entry] = True
    visited = []
    live = np.arange(n)
    while len(live):
        rest = np.where(opened[live], far, dist[live])
        at = rest.argmin(axis=1)
        going = ~opened[live, at]
        live, at = live[going], at[going]
        if not len(live):
            break
        current = ids[live, at]
        opened[live, at] = True
        step = np.full(n, -1, dtype=np.int64)
        step[live] = current
        visited.append(step)
        near = graph[current].astype(np.int64)
        fresh = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        row, col = np.nonzero(fresh)
        seen[live[row], near[row, col]] = True
        d = np.where(fresh, distance(queries[live], np.maximum(near, 0)), far)
        all_d = np.concatenate([dist[live], d], axis=1)
        all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
        all_open = np.concatenate([opened[live], ~fresh], axis=1)
        keep = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
        dist[live] = np.take_along_axis(all_d, keep, 1)
        ids[live] = np.take_along_axis(all_ids, keep, 1)
        opened[live] = np.take_along_axis(all_open, keep, 1)
    order = np.argsort(dist, axis=1, kind="stable")
    ids = np.where(np.isfinite(dist), ids, -1)
    return np.take_along_axis(ids, order, 1), np.stack(visited, axis=1)
