"""Embedding near-dedup with a robust-pruned flat graph.

Vectors are compared within their label by cosine. Equal vectors are one class first, so
copies cost nothing. The classes of a label are dealt to overlapping shards around pivots: a
vector is at home in the shard of its nearest pivot and a guest in that of the second one.
Each shard builds a flat graph whose lists are pruned robustly (a neighbour is dropped when
one that is kept lies much closer to it), and the lists of a vector are united over its
shards. Every vector is then a query to the shards of its nearest pivots: greedy search with
a beam starts at a shard's medoid, and from what it finds in range the search expands along
the graph as long as it stays in range. All links are verified in double precision; a link is
counted where its node is at home. :func:`audit_recall` compares with brute force.

A shard with more than ``SHARD_ROWS`` members, such as a large group of near copies, is dealt
into blocks by hash, and its queries search all of them: no task holds more than a block of
nodes and a block of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from reelrank.llm.components import components
from reelrank.sources.durable import durable

THRESHOLD = 0.93
#: Members of a block of nodes, and queries of a block.
SHARD_ROWS = 600
#: Pivots of a label at most, and of all labels: 8192 vectors of a few hundred bytes.
LABEL_PIVOTS = 512
MAX_PIVOTS = 8192
#: Shards that a query searches.
PROBES = 4
#: Neighbours of a vector within a shard: the pruned near ones, and far ones that are drawn
#: from the whole shard and keep dense groups of it connected.
DEGREE, FAR = 24, 8
CANDIDATES = 64
ALPHA = 1.2
BEAM = 16


def _can_link() -> Column:
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    ok = finite & F.exists("embedding", lambda x: x != 0)
    named = F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    return named & F.coalesce(ok, F.lit(False))


def usable(vectors: DataFrame) -> DataFrame:
    """Rows that can link: a label, and a vector that is finite and not zero."""
    return vectors.filter(_can_link()).withColumn(
        "embedding", F.transform("embedding", lambda x: x.cast("double"))
    )


def _unit(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    flat = pa.array(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)
    values = flat.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
    # Scaling by the largest part first keeps squares of very large and small parts finite.
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


def pivots(classes: DataFrame, shard_rows: int = SHARD_ROWS) -> pd.DataFrame:
    """``(label, width, pivot, embedding)``: a bounded sample of each group's vectors.

    Groups with one shard have no pivots; of others, the vectors with the least hashes.
    """
    counts = classes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("n"))
    wanted = F.least(F.lit(LABEL_PIVOTS), F.ceil(2 * F.col("n") / shard_rows))
    sized = counts.filter(F.col("n") > shard_rows).withColumn("k", wanted)
    total = sized.agg(F.sum("k")).first()[0] or 0
    shrink = min(1.0, MAX_PIVOTS / max(1, total))
    sized = sized.withColumn("k", F.floor(F.col("k") * shrink)).filter("k > 1")
    order = Window.partitionBy("label", "width").orderBy(F.xxhash64("id"), "id")
    first = (
        classes.select("label", "width", "id", "embedding")
        .withColumn("pivot", F.row_number().over(order) - 1)
        .filter(F.col("pivot") < LABEL_PIVOTS)
    )
    return (
        first.join(sized.select("label", "width", "k"), ["label", "width"])
        .filter(F.col("pivot") < F.col("k"))
        .select("label", "width", "pivot", "embedding")
        .toPandas()
    )


def _apart(unit: np.ndarray) -> np.ndarray:
    """Pivots without those that would link with an earlier one, so that a dense group of
    near copies falls to one pivot and stays in one shard."""
    alike = unit @ unit.T >= THRESHOLD
    keep: list[int] = []
    for i in range(len(unit)):
        if not alike[i, keep].any():
            keep.append(i)
    return unit[keep]


def shards(classes: DataFrame, shard_rows: int = SHARD_ROWS, probes: int = PROBES) -> DataFrame:
    """``classes`` with ``near array<int>``: the nearest pivots, the home shard first."""
    sample = pivots(classes, shard_rows)
    tables = {
        key: _apart(_unit(pa.array(list(rows.sort_values("pivot")["embedding"])), key[1]))
        for key, rows in sample.groupby(["label", "width"])
    }
    shared = classes.sparkSession.sparkContext.broadcast(tables)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy(zero_copy_only=False)
            width = batch.column("width").to_numpy()
            near = [[0]] * len(label)
            for key in set(zip(label.tolist(), width.tolist(), strict=True)):
                table = shared.value.get(key)
                if table is None:
                    continue
                rows = np.flatnonzero((label == key[0]) & (width == key[1]))
                unit = _unit(batch.column("embedding").take(pa.array(rows)), key[1])
                order = np.argsort(-(unit @ table.T), axis=1, kind="stable")[:, :probes]
                for row, found in zip(rows, order.tolist(), strict=True):
                    near[row] = found
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "near"],
            )

    schema = ", ".join(f"{name} {kind}" for name, kind in classes.dtypes)
    return classes.mapInArrow(assign, f"{schema}, near array<int>")


def robust_lists(unit: np.ndarray) -> np.ndarray:
    """Neighbour lists of a shard's vectors: ``(n, DEGREE + FAR)``, -1 where none is left."""
    n = len(unit)
    far = np.random.default_rng(n).integers(0, n, (n, FAR))
    lists = np.full((n, DEGREE), -1, dtype=np.int64)
    if n < 2:
        return lists
    alike = unit @ unit.T
    distance = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * alike))
    np.fill_diagonal(alike, -2.0)
    width = min(CANDIDATES, n - 1)
    near = np.argpartition(-alike, width - 1, axis=1)[:, :width]
    rows = np.arange(n)
    near = np.take_along_axis(
        near, np.argsort(-np.take_along_axis(alike, near, axis=1), axis=1, kind="stable"), axis=1
    )
    count = np.zeros(n, dtype=np.int64)
    for j in range(width):
        c = near[:, j]
        between = distance[lists, c[:, None]]
        shadowed = (lists >= 0) & (ALPHA * between <= distance[rows, c][:, None])
        fit = ~shadowed.any(axis=1) & (count < DEGREE)
        lists[rows[fit], count[fit]] = c[fit]
        count += fit
    return np.concatenate([lists, far], axis=1)


def _build(table: pa.Table) -> pa.Table:
    """``(id, lists)`` of one block of a shard."""
    ids = table.column("id").to_numpy()
    lists = robust_lists(_unit(table.column("embedding"), table.column("width")[0].as_py()))
    found = [ids[row[row >= 0]] for row in lists]
    return pa.table({"id": pa.array(ids), "lists": pa.array(found, pa.list_(pa.int64()))})


def range_search(
    queries: np.ndarray, nodes: np.ndarray, lists: np.ndarray, threshold: float
) -> np.ndarray:
    """For each query, the nodes found with a cosine of ``threshold`` or more."""
    alike = queries @ nodes.T
    n = len(nodes)
    medoid = int(np.argmax(nodes @ nodes.mean(axis=0)))
    seen = np.zeros(alike.shape, dtype=bool)
    seen[:, medoid] = True
    rows = np.arange(len(queries))[:, None]
    width = min(BEAM, n)
    filled = np.where(lists >= 0, lists, np.arange(n)[:, None])
    last = None
    while True:
        known = np.where(seen, alike, -2.0)
        beam = np.sort(np.argpartition(-known, width - 1, axis=1)[:, :width], axis=1)
        if last is not None and np.array_equal(beam, last):
            break
        last = beam
        expand = np.where(np.take_along_axis(seen, beam, axis=1), beam, medoid)
        seen[rows, filled[expand].reshape(len(queries), -1)] = True
    inside = alike >= threshold
    found = seen & inside
    graph = np.zeros((n, n), dtype=np.float32)
    graph[np.arange(n)[:, None], filled] = 1
    graph = np.maximum(graph, graph.T)
    while True:
        wider = found | ((found.astype(np.float32) @ graph > 0) & inside)
        if np.array_equal(wider, found):
            return found
        found = wider


def _search(threshold: float):
    def search(table: pa.Table) -> pa.Table:
        """Links of one block of queries in one block of nodes: counts, and edges that keep
        what is connected so."""
        asked = table.column("asked").to_numpy(zero_copy_only=False).astype(bool)
        width = table.column("width")[0].as_py()
        unit = _unit(table.column("embedding"), width)
        ids = table.column("id").to_numpy()
        empty = pa.table(
            {c: pa.array([], pa.int64()) for c in ("id", "n", "other")}
        )
        if asked.all() or not asked.any():
            return empty
        node_ids, query_ids = ids[~asked], ids[asked]
        home = table.column("home").to_numpy(zero_copy_only=False).astype(bool)[~asked]
        copies = table.column("copies").to_numpy()[~asked]
        place = {v: i for i, v in enumerate(node_ids.tolist())}
        united = [
            [place[v] for v in row or () if v in place]
            for row, q in zip(table.column("lists").to_pylist(), asked, strict=True)
            if not q
        ]
        lists = np.full((len(united), max(1, *map(len, united))), -1, dtype=np.int64)
        for i, row in enumerate(united):
            lists[i, : len(row)] = row
        found = range_search(unit[asked], unit[~asked], lists, threshold)
        found &= home[None, :] & (query_ids[:, None] != node_ids[None, :])
        linked = found.any(axis=1)
        found, query_ids = found[linked], query_ids[linked]
        if len(found) == 0:
            return empty
        n = found @ copies
        q, m = query_ids.copy(), node_ids.copy()
        far = np.iinfo(np.int64).max
        while True:
            low_q = np.minimum(q, np.where(found, m[None, :], far).min(axis=1))
            low_m = np.minimum(m, np.where(found, low_q[:, None], far).min(axis=0))
            if np.array_equal(low_q, q) and np.array_equal(low_m, m):
                break
            q, m = low_q, low_m
        met = found.any(axis=0)
        return pa.table(
            {
                "id": np.concatenate([query_ids, node_ids[met]]),
                "n": np.concatenate([n, np.zeros(int(met.sum()), np.int64)]),
                "other": np.concatenate([q, m[met]]),
            }
        )

    return search


def _block(of: str, count: Column) -> Column:
    return F.pmod(F.xxhash64(F.lit(of), "id"), count).cast("int")


def class_links(
    classes: DataFrame,
    threshold: float = THRESHOLD,
    shard_rows: int = SHARD_ROWS,
    probes: int = PROBES,
) -> DataFrame:
    """``(id, n, other)`` from ``classes (label, width, embedding, id, copies)``: numbers of
    linked vectors, to be added up, and edges ``id - other`` within components."""
    placed = durable(shards(classes, shard_rows, probes), "shards")
    group = ["label", "width", "shard"]
    blocks = lambda df: df.groupBy(*group).agg(
        F.ceil(F.count(F.lit(1)) / shard_rows).alias("blocks")
    )
    member = placed.select(
        "*", F.posexplode(F.slice("near", 1, 2)).alias("rank", "shard")
    ).withColumn("home", F.col("rank") == 0)
    size = blocks(member)
    member = durable(
        member.join(size, group)
        .withColumn("block", _block("node", F.col("blocks")))
        .drop("rank", "near", "blocks"),
        "members",
    )
    columns = "id long, lists array<bigint>"
    built = member.groupBy(*group, "block").applyInArrow(_build, columns)
    united = built.groupBy("id").agg(
        F.array_distinct(F.flatten(F.collect_list("lists"))).alias("lists")
    )
    nodes = member.join(united, "id").withColumn("asked", F.lit(False))
    asking = placed.select("*", F.explode("near").alias("shard"))
    asking = (
        asking.join(blocks(asking).withColumnRenamed("blocks", "query_blocks"), group)
        .withColumn("query_block", _block("query", F.col("query_blocks")))
        .join(size, group)
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1)))
        .withColumn("asked", F.lit(True))
        .withColumn("home", F.lit(False))
        .withColumn("lists", F.lit(None).cast("array<bigint>"))
    )
    spread = nodes.join(blocks(placed.select("*", F.explode("near").alias("shard"))), group)
    spread = spread.withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    )
    fields = [*group, "block", "query_block", "asked", "home", "id", "copies", "embedding", "lists"]
    both = spread.select(*fields).unionByName(asking.select(*fields))
    return both.groupBy(*group, "block", "query_block").applyInArrow(
        _search(threshold), "id long, n long, other long"
    )


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    ``vectors`` has ``vec_id, embedding, label``. Only vectors of one label and one length are
    compared. ``n_links`` counts the other rows linked directly, ``component_id`` is the least
    ``vec_id`` reachable, itself included, and ``kept`` tells whether it is the row's own.
    Vectors that are null, zero, or hold null or non-finite parts, and rows without label,
    link with nothing; rows without ``vec_id`` are returned with nulls. Rows that repeat a
    vector are copies of one another, also under one ``vec_id``; each row has its result. An empty table gives an empty result.
    """
    plain = vectors.select("vec_id", "embedding", "label")
    valid = usable(plain).withColumn("width", F.size("embedding"))
    same = ["label", "width", "embedding"]
    classes = durable(
        valid.groupBy(*same).agg(
            F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies")
        ),
        "classes",
    )
    links = durable(class_links(classes, threshold), "vector-links")
    counts = links.groupBy("id").agg(F.sum("n").alias("n"))
    found = components(links.select(F.col("id").alias("a"), F.col("other").alias("b")))
    ends = (
        classes.join(counts, "id", "left")
        .join(found, "id", "left")
        .withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1)
        .withColumn("component_id", F.coalesce("component_id", "id"))
        .select(*same, "n_links", "component_id")
    )
    linked = valid.join(ends, same).select("vec_id", "n_links", "component_id")
    rest = plain.filter(~_can_link()).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def audit_recall(
    vectors: DataFrame, result: DataFrame, every: int = 20, threshold: float = THRESHOLD
) -> DataFrame:
    """One row ``(found, true)``: links found and links there are, for the rows whose
    ``vec_id`` is divisible by ``every``, against all rows by brute force.

    Queries travel in blocks; each block meets all vectors of its label once.
    """
    valid = usable(vectors.select("vec_id", "embedding", "label"))
    queries = valid.filter(F.col("vec_id") % every == 0)
    blocks = (
        queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(64)))
        .groupBy("label", "block")
        .agg(F.collect_list(F.struct("vec_id", "embedding")).alias("queries"))
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = batch.column("queries").to_pylist()
            own = batch.column("embedding").to_pylist()
            total = 0
            for vec_id, one, block in zip(
                batch.column("vec_id").to_pylist(), own, asked, strict=True
            ):
                fit = [q for q in block if len(q["embedding"]) == len(one) and q["vec_id"] != vec_id]
                if fit:
                    many = _unit(pa.array([q["embedding"] for q in fit]), len(one))
                    total += int((many @ _unit(pa.array([one]), len(one))[0] >= threshold).sum())
            yield pa.record_batch([pa.array([total], pa.int64())], names=["n"])

    true = valid.join(blocks, "label").mapInArrow(count, "n long").agg(F.sum("n").alias("true"))
    found = (
        result.filter(F.col("vec_id") % every == 0).agg(F.sum("n_links").alias("found"))
    )
    return found.select("found", F.lit(true.scalar()).alias("true"))
