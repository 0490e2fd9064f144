"""Near-duplicate vectors with a robust-pruned flat graph."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlake.llm.components import components
from txlake.plans.session import shared_folder

SHARD = 1500  # vectors of a shard that is not split further
LEADERS = 16
LEADER_SAMPLE = 400  # vectors of a shard among which leaders are chosen
LEADER_COSINE = 0.8  # leaders are less alike than this
GAIN = 0.75  # a shard is split if its parts hold at most this share of its pairs
NEAREST, RANDOM, DEGREE, ALPHA = 32, 16, 24, 1.2
BEAM = 24
AUDIT = 256  # queries of an audit


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit vectors in double precision."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(lists)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)
    # Scaled first, so that squares of very large or small components stay finite.
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def robust_prune(near: np.ndarray, pool: np.ndarray, between: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours of a point from a pool: again and again the nearest is taken, and those are left out
    that are ALPHA times nearer to it than to the point. near, between: squared distances to the point and among the pool."""
    alive = np.ones(len(pool), dtype=bool)
    chosen = []
    for i in np.argsort(near, kind="stable"):
        if alive[i]:
            chosen.append(i)
            if len(chosen) == degree:
                break
            alive &= ALPHA * between[i] > near
    return pool[chosen]


def build(x: np.ndarray, seed: int) -> list[np.ndarray]:
    """Neighbours of each row: pruned from its nearest and some random rows, links in both directions."""
    n = len(x)
    rng = np.random.default_rng(seed)
    links: list[list[int]] = [[] for _ in range(n)]
    for begin in range(0, n, 256):
        rows = np.arange(begin, min(n, begin + 256))
        cosine = x[rows] @ x.T
        cosine[np.arange(len(rows)), rows] = -2
        k = min(NEAREST, n - 1)
        nearest = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k else np.empty((len(rows), 0), dtype=int)
        for r, found in zip(rows, nearest, strict=True):
            pool = np.unique(np.concatenate([found, rng.integers(0, n, RANDOM)]))
            pool = pool[pool != r]
            between = 2 - 2 * (x[pool] @ x[pool].T)
            for other in robust_prune(2 - 2 * (x[pool] @ x[r]), pool, between, DEGREE):
                links[r].append(int(other))
                links[other].append(int(r))
    return [np.unique(np.array(found, dtype=np.int64)) for found in links]


def range_search(x: np.ndarray, links: list[np.ndarray], entry: int, query: int, cosine: float) -> np.ndarray:
    """Rows within the cosine of a row: greedy search with a beam from the entry and from the row itself; every row in
    range is expanded as well, however many there are."""
    seen = np.zeros(len(x), dtype=bool)
    todo = np.unique(np.array([entry, query]))
    seen[todo] = True
    pool, near = todo, x[todo] @ x[query]
    expanded = np.zeros(len(todo), dtype=bool)
    while True:
        best = np.zeros(len(pool), dtype=bool)
        best[np.argsort(-near, kind="stable")[:BEAM]] = True
        go = ~expanded & (best | (near >= cosine))
        if not go.any():
            found = pool[near >= cosine]
            return found[found != query]
        expanded |= go
        fresh = np.unique(np.concatenate([links[i] for i in pool[go]]))
        fresh = fresh[~seen[fresh]]
        seen[fresh] = True
        keep = best | (near >= cosine)
        pool = np.concatenate([pool[keep], fresh])
        near = np.concatenate([near[keep], x[fresh] @ x[query]])
        expanded = np.concatenate([expanded[keep], np.zeros(len(fresh), dtype=bool)])


def _leaders(table: pa.Table) -> pa.Table:
    x = _matrix(table.column("vector"))
    chosen: list[int] = []
    for i in np.argsort(table.column("node").to_numpy()):
        if len(chosen) < LEADERS and (not chosen or (x[chosen] @ x[i]).max() < LEADER_COSINE):
            chosen.append(int(i))
    return pa.table({"shard": table.column("shard").slice(0, 1), "leaders": pa.array([x[chosen].ravel().tolist()])})


def _two_nearest(vectors: pa.Array, leaders: pa.Array) -> pa.Array:
    out = []
    x = _matrix(vectors)
    for row, flat in zip(x, leaders, strict=True):
        centres = flat.values.to_numpy().reshape(-1, x.shape[1])
        out.append(np.argsort(-(centres @ row), kind="stable")[:2].astype(np.int32))
    return pa.array(out, pa.list_(pa.int32()))


def _shards(nodes: DataFrame) -> DataFrame:
    """(shard, node, n): clusters of vectors, overlapping in that a vector goes to its two nearest leaders. Shards of more
    than SHARD vectors are split unless the squares of their parts' sizes add up to more than GAIN of their own, as when one
    or two tight clusters fill them. So rows grow at most by a power of the size, and rounds by its logarithm."""
    nearest = F.arrow_udf(_two_nearest, "array<int>")
    members = nodes.select(F.xxhash64("group").alias("shard"), "node", "vector").checkpoint()
    done = []
    while True:
        sizes = members.groupBy("shard").agg(F.count("*").alias("n"))
        big = sizes.filter(F.col("n") > SHARD)
        done.append(members.join(sizes.filter(F.col("n") <= SHARD), "shard").select("shard", "node", "n"))
        rest = members.join(big, "shard")
        sample = rest.filter(F.pmod(F.xxhash64("node", "shard"), F.col("n")) < LEADER_SAMPLE)
        leaders = sample.select("shard", "node", "vector").groupBy("shard").applyInArrow(
            _leaders, "shard bigint, leaders array<double>"
        )
        led = rest.join(leaders, "shard").withColumn("nearest", nearest("vector", "leaders")).drop("leaders").checkpoint()
        parts = led.select("shard", "n", F.explode("nearest").alias("leader")).groupBy("shard", "n", "leader").count()
        pairs = F.sum(F.col("count").cast("double") * F.col("count"))
        split = parts.groupBy("shard", "n").agg((pairs <= GAIN * F.col("n") * F.col("n")).alias("split")).drop("n")
        judged = led.join(split, "shard").checkpoint()
        done.append(judged.filter(~F.col("split")).select("shard", "node", "n"))
        members = judged.filter("split").select(F.explode("nearest").alias("leader"), "shard", "node", "vector").select(
            F.xxhash64("shard", "leader").alias("shard"), "node", "vector"
        ).checkpoint()
        if members.isEmpty():
            out = done[0]
            for part in done[1:]:
                out = out.union(part)
            return out


def _tasks(shards: DataFrame) -> DataFrame:
    """(task, node): a shard, or each pair of blocks of a shard that is too large for one task."""
    blocks = F.ceil(F.col("n") / SHARD).cast("int")
    block = F.pmod(F.xxhash64("node", F.lit("block")), blocks).cast("int")
    pair = F.transform(
        F.sequence(F.lit(0), blocks - 1), lambda o: F.xxhash64("shard", F.least(o, block), F.greatest(o, block))
    )
    return shards.select("node", F.explode(pair).alias("task"))


def _build_task(table: pa.Table) -> pa.Table:
    nodes = table.column("node").to_numpy()
    order = np.argsort(nodes)
    links = build(_matrix(table.column("vector"))[order], int(table.column("task")[0].as_py()) & 0xFFFFFFFF)
    nodes = nodes[order]
    return pa.table({"node": nodes, "links": pa.array([nodes[found] for found in links], pa.list_(pa.int64()))})


def _search_task(table: pa.Table, cosine: float) -> pa.Table:
    """(node, n_links, root): links that this task counts, and the smallest node of the part it belongs to."""
    nodes = table.column("node").to_numpy()
    order = np.argsort(nodes)
    nodes, x = nodes[order], _matrix(table.column("vector"))[order]
    weight = table.column("weight").to_numpy()[order]
    task = table.column("task")[0].as_py()
    tasks = [set(t) for t in table.column("tasks").take(pa.array(order)).to_pylist()]
    several = np.array([len(t) > 1 and min(t) < task for t in tasks])
    # The union holds links to vectors of other shards; those are followed there.
    links = []
    for found in table.column("links").take(pa.array(order)).to_pylist():
        found = np.asarray(found, dtype=np.int64)
        at = np.minimum(np.searchsorted(nodes, found), len(nodes) - 1)
        links.append(at[nodes[at] == found])
    medoid = int((x @ x.mean(axis=0)).argmax())
    count = np.zeros(len(nodes), dtype=np.int64)
    parent = np.arange(len(nodes))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for q in range(len(nodes)):
        found = range_search(x, links, medoid, q, cosine)
        if not len(found):
            continue
        for i in {root(i) for i in found}:
            a, b = root(q), i
            parent[max(a, b)] = min(a, b)
        if several[q]:
            # A pair is counted in the smallest task that holds both.
            lower = {t for t in tasks[q] if t < task}
            found = np.array([i for i in found if not several[i] or lower.isdisjoint(tasks[i])], dtype=np.int64)
        count[q] = weight[found].sum()
    roots = np.array([nodes[root(i)] for i in range(len(nodes))])
    return pa.table({"node": nodes, "n_links": count, "root": roots})


def near_duplicate_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", group: str | None = "label", cosine: float = 0.98
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Vectors of the same group are linked when their cosine, in double precision, is at least `cosine`; n_links counts the
    other rows linked directly, component_id is the smallest id that links reach. A vector that is null, empty, zero or
    has a null or non-finite component, or whose group is null, has no links; without `group` all rows are one
    group. Vectors of different lengths are never linked. Equal vectors are one node and linked to each other, rows that
    repeat an id are vectors of their own. Other columns are not read, whatever their names.

    Each shard of a group's overlapping clusters is linked by robust pruning, the lists of a node are united over its
    shards, and every vector is searched from the medoid of its shards and from itself. Every pair found is verified; pairs that no
    shard holds or that the search misses are what recall loses (`audit` measures it).
    """
    shared_folder(vectors.sparkSession)
    rows = vectors.select(
        F.col(vec_id).alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"),
        (F.col(group) if group else F.lit(0)).alias("label"),
    )
    big = F.lit(float("inf"))
    usable = (
        F.col("label").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0)
        & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < big))
        & F.exists("vector", lambda v: v != 0)
    )
    rows = rows.withColumn("key", F.when(F.coalesce(usable, F.lit(False)), F.xxhash64("label", "vector")))
    distinct = rows.filter(F.col("key").isNotNull()).groupBy("key", "label", "vector").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least")
    )
    nodes = distinct.select(
        F.monotonically_increasing_id().alias("node"), "key", "label", "vector", "weight", "least",
        F.xxhash64("label", F.size("vector")).alias("group"),
    ).checkpoint()
    tasks = _tasks(_shards(nodes)).distinct().checkpoint()
    placed = tasks.join(nodes.select("node", "vector", "weight"), "node")
    graph = placed.select("task", "node", "vector").groupBy("task").applyInArrow(_build_task, "node bigint, links array<bigint>")
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("links"))).alias("links"))
    held = tasks.groupBy("node").agg(F.sort_array(F.collect_set("task")).alias("tasks"))
    found = (
        placed.join(united, "node").join(held, "node").groupBy("task")
        .applyInArrow(lambda t: _search_task(t, cosine), "node bigint, n_links bigint, root bigint").checkpoint()
    )
    parts = components(found.filter(F.col("node") != F.col("root")).select(F.col("node").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("node").agg(F.sum("n_links").alias("n_links"))
    whole = nodes.join(counts, "node").join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    least = whole.groupBy("part").agg(F.min("least").alias("component_id"))
    known = whole.join(least, "part").select(
        F.col("key").alias("k"), F.col("label").alias("l"), F.col("vector").alias("x"),
        (F.col("n_links") + F.col("weight") - 1).alias("n_links"), "component_id",
    )
    linked = rows.join(known, (F.col("key") == F.col("k")) & (F.col("label") == F.col("l")) & (F.col("vector") == F.col("x")), "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return linked.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


def audit(
    vectors: DataFrame, result: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", group: str = "label",
    cosine: float = 0.98,
) -> float:
    """Share of the links of at most AUDIT vectors with links that a comparison with all vectors finds; ids must be unique."""
    asked = result.filter("n_links > 0").select("vec_id", "n_links").orderBy(F.xxhash64("vec_id")).limit(AUDIT)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("vector"), F.col(group).alias("label"))
    queries = asked.join(rows, "vec_id").toArrow()
    if not len(queries):
        return 1.0
    q, labels = _matrix(queries.column("vector")), np.asarray(queries.column("label").to_pylist())
    ids = np.asarray(queries.column("vec_id").to_pylist())

    def compare(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            near = q @ _matrix(table.column("vector")).T >= cosine
            near &= labels[:, None] == np.asarray(table.column("label").to_pylist())[None, :]
            yield pa.record_batch({"vec_id": pa.array(ids.astype(np.int64)), "n": near.sum(axis=1).astype(np.int64)})

    usable = rows.filter(F.col("label").isNotNull() & (F.size("vector") == q.shape[1])).filter(
        F.exists("vector", lambda v: v != 0) & F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v))
    )
    true = usable.mapInArrow(compare, "vec_id bigint, n bigint").agg(F.sum("n")).first()[0] - len(ids)
    return sum(queries.column("n_links").to_pylist()) / max(1, true)
