"""Nearest neighbours by a hierarchical k-means tree, searched best bin first.

The tree is fitted on a sample of at most about ``FIT_VALUES`` numbers; every
distinct vector of the table is then put into its leaf. A query walks the tree
with a priority queue of nodes by distance to their centres and visits leaves in
that order. How many leaves it visits is calibrated: for a sample of queries the
true neighbours are found by brute force, and the visits are widened until the
leaves seen hold the wanted share of them. A query whose leaves hold too few rows to
answer it with ``k`` walks on until they do.

Equal vectors are searched once: of each only the ``k`` + 1 smallest ids can be
among the ``k`` nearest, ties going to the smaller id, and so no more are kept. A
leaf is cut into blocks by a hash of the vector, and its queries likewise, so no
task holds a whole leaf. The first ``FIRST_LEAVES`` of a query return their ``k`` + 1
nearest each and so a bound on the ``k``-th distance. Of the leaves after them those
are skipped whose radius does not reach within the bound, and the others return only
what lies within it, so rows written grow with the queries and not with the leaves.

Defined cases: vectors that are null, zero, or hold null or non-finite numbers take
no part, nor do those of another length than the most frequent one (the larger, if
two are as frequent); a null id takes no part; rows with the same id and vector
count once; an id with two vectors is two candidates, and two queries with the same
``query_id``; with fewer than ``k`` candidates all of them are returned; an empty
table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rollbook.llm.common import hash_below, sample_share, strings, write_scratch

FIT_VALUES = 1_280_000
BRANCHES = 8
LEAF_SAMPLE = 32
ROUNDS = 8
CALIBRATION_QUERIES = 200
TARGET_RECALL = 0.98
#: Leaves that are searched without a bound.
FIRST_LEAVES = 4
#: Vectors, and queries, that one task compares at once.
BLOCK_VECTORS = 8_192
BLOCK_QUERIES = 1_024
PATHS = "key string, vec array<double>, leaves array<int>, bound double"


@dataclass
class Tree:
    """Node 0 is the root; children of node i are first[i] to first[i] + size[i] - 1, none for a leaf."""

    centres: np.ndarray
    first: np.ndarray
    size: np.ndarray

    def assign(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector: the nearest child, from the root down."""
        node = np.zeros(len(vectors), np.int64)
        open_rows = np.arange(len(vectors)) if len(self.size) and self.size[0] else np.zeros(0, np.int64)
        while len(open_rows):
            for parent in np.unique(node[open_rows]):
                rows = open_rows[node[open_rows] == parent]
                children = slice(self.first[parent], self.first[parent] + self.size[parent])
                node[rows] = self.first[parent] + _nearest(vectors[rows], self.centres[children])
            open_rows = open_rows[self.size[node[open_rows]] > 0]
        return node

    def leaves(self, query: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, node = heapq.heappop(queue)
            if not self.size[node]:
                yield node
                continue
            children = range(self.first[node], self.first[node] + self.size[node])
            gaps = ((self.centres[children.start : children.stop] - query) ** 2).sum(axis=1)
            for gap, child in zip(gaps.tolist(), children, strict=True):
                heapq.heappush(queue, (gap, child))


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * vectors @ centres.T).argmin(axis=1)


def _kmeans(vectors: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    centres = vectors[rng.choice(len(vectors), count, replace=False)]
    for _ in range(ROUNDS):
        group = _nearest(vectors, centres)
        full = np.unique(group)
        centres = np.stack([vectors[group == g].mean(axis=0) for g in full])
    return centres


def grow_tree(vectors: np.ndarray, seed: int = 3) -> Tree:
    """Split the sample again and again; a group that k-means cannot split is a leaf."""
    rng = np.random.default_rng(seed)
    vectors = np.unique(vectors, axis=0)
    centres = [vectors.mean(axis=0) if len(vectors) else np.zeros(vectors.shape[1])]
    first, size = [0], [0]
    waiting = [(0, vectors)]
    while waiting:
        node, group = waiting.pop()
        if len(group) <= LEAF_SAMPLE:
            continue
        found = _kmeans(group, min(BRANCHES, len(group)), rng)
        member = _nearest(group, found)
        full = np.unique(member)
        if len(full) < 2:
            continue
        first[node], size[node] = len(centres), len(full)
        for child in full:
            centres.append(found[child])
            first.append(0)
            size.append(0)
            waiting.append((len(centres) - 1, group[member == child]))
    return Tree(np.array(centres), np.array(first), np.array(size))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def valid_vectors(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, key, vec): the rows that take part; ``key`` stands for the vector's value."""
    vec = F.col(vector).cast("array<double>")
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.select(F.col(key).cast("long").alias("id"), vec.alias("vec")).where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & ~bad & F.exists("vec", lambda x: x != 0)
    )
    lengths = rows.groupBy(F.size("vec").alias("length")).agg(F.count(F.lit(1)).alias("rows"))
    top = lengths.orderBy(F.desc("rows"), F.desc("length")).first()
    return rows.where(F.size("vec") == (top["length"] if top else 0)).withColumn("key", F.md5(F.col("vec").cast("string").cast("binary")))


def _classes(valid: DataFrame, keep: int) -> DataFrame:
    """One row per distinct vector with its smallest ids; the limit works before the shuffle."""
    once = valid.groupBy("key", "id").agg(F.first("vec").alias("vec"))
    ranked = once.withColumn("n", F.row_number().over(Window.partitionBy("key").orderBy("id"))).where(F.col("n") <= keep)
    return ranked.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"), F.first("vec").alias("vec"))


def _with_leaf(classes: DataFrame, tree: Tree) -> DataFrame:
    sent = classes.sparkSession.sparkContext.broadcast(tree)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = sent.value.assign(_matrix(batch.column("vec"))) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf.astype(np.int32))], [*batch.schema.names, "leaf"])

    return classes.mapInArrow(task, "key string, ids array<long>, vec array<double>, leaf int")


def _closest(queries: np.ndarray, vectors: np.ndarray, keep: int, bounds: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its nearest vectors and their distances, all that tie with the last one too; none beyond its bound."""
    step = max(1, 2_000_000 // max(1, vectors.size))
    for low in range(0, len(queries), step):
        gap = queries[low : low + step, None, :] - vectors[None]
        distance = np.sqrt(np.einsum("qvd,qvd->qv", gap, gap))
        last = np.partition(distance, keep - 1, axis=1)[:, keep - 1] if distance.shape[1] > keep else np.full(len(distance), np.inf)
        if bounds is not None:
            last = np.minimum(last, bounds[low : low + step])
        for i, row in enumerate(distance):
            near = np.flatnonzero(row <= last[i])
            yield low + i, near, row[near]


def _calibrate(indexed: DataFrame, queries: DataFrame, tree: Tree, k: int, target: float, seed: int) -> int:
    """Leaves to visit so that sampled queries see the wanted share of their true neighbours."""
    spark = indexed.sparkSession
    rows = queries.count()
    sample = queries.where(hash_below(["key"], sample_share(rows, CALIBRATION_QUERIES), seed)).select("key", "vec").toArrow()
    if not sample.num_rows:
        sample = queries.orderBy("key").limit(1).select("key", "vec").toArrow()
    if not sample.num_rows:
        return 1
    vectors = _matrix(sample.column("vec").combine_chunks())
    sent = spark.sparkContext.broadcast(vectors)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[float, int]]] = [[] for _ in sent.value]
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            for q, near, distance in _closest(sent.value, _matrix(batch.column("vec")), k + 1):
                best[q] = sorted(best[q] + list(zip(distance.tolist(), leaf[near].tolist(), strict=True)))[: k + 1]
        flat = [(q, d, at) for q, found in enumerate(best) for d, at in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in flat], pa.int32()), pa.array([x[1] for x in flat], pa.float64()), pa.array([x[2] for x in flat], pa.int32())],
            ["query", "distance", "leaf"],
        )

    near = indexed.select("vec", "leaf").mapInArrow(task, "query int, distance double, leaf int")
    order = Window.partitionBy("query").orderBy("distance", "leaf")
    # The first one is the query's own vector.
    true = near.withColumn("n", F.row_number().over(order)).where((F.col("n") > 1) & (F.col("n") <= k + 1)).collect()
    place = [{leaf: at for at, leaf in enumerate(tree.leaves(q))} for q in vectors]
    ranks = sorted(place[r["query"]][r["leaf"]] + 1 for r in true)
    if not ranks:
        return 1
    return ranks[min(len(ranks) - 1, int(np.ceil(target * len(ranks))) - 1)]


def _held(indexed: DataFrame) -> dict[int, int]:
    """Rows per leaf that count for any query: of ids with several vectors, all but the one with most of them there."""
    rows = indexed.select("leaf", F.explode("ids").alias("id")).groupBy("id", "leaf").agg(F.count(F.lit(1)).alias("rows"))
    rows = write_scratch(rows, "leaf_ids")
    repeated = rows.groupBy("id").agg(F.sum("rows").alias("n")).where("n > 1").select("id")
    most = rows.join(repeated, "id", "left_semi").groupBy("leaf").agg(F.max("rows").alias("most"))
    counted = rows.groupBy("leaf").agg(F.sum("rows").alias("rows")).join(most, "leaf", "left")
    return {r["leaf"]: r["rows"] - (r["most"] or 0) for r in counted.collect()}


def _path(tree: Tree, query: np.ndarray, visits: int, held: dict[int, int], least: int) -> list[int]:
    """The leaves a query visits: so many, and on until they hold ``least`` rows."""
    path, rows = [], 0
    for leaf in tree.leaves(query):
        if len(path) >= visits and rows >= least:
            break
        path.append(leaf)
        rows += held.get(leaf, 0)
    return path


def _radii(indexed: DataFrame, tree: Tree) -> dict[int, float]:
    """The greatest distance of a leaf's vectors from its centre; the tree bounds how many there are."""
    sent = indexed.sparkSession.sparkContext.broadcast(tree)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = batch.column("leaf").to_numpy()
            away = np.sqrt(((_matrix(batch.column("vec")) - sent.value.centres[leaf]) ** 2).sum(axis=1)) if len(leaf) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("leaf"), pa.array(away)], ["leaf", "away"])

    away = indexed.select("vec", "leaf").mapInArrow(task, "leaf int, away double").groupBy("leaf").agg(F.max("away").alias("away"))
    return {r["leaf"]: r["away"] for r in away.collect()}


def _first_visits(queries: DataFrame, tree: Tree, first: int) -> DataFrame:
    """(key, vec, leaves, bound): the leaves that are searched without a bound."""
    sent = queries.sparkSession.sparkContext.broadcast(tree)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(islice(sent.value.leaves(q), first)) for q in _matrix(batch.column("vec"))]
            bound = pa.array([None] * len(found), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.list_(pa.int32())), bound], ["key", "vec", "leaves", "bound"])

    return queries.select("key", "vec").mapInArrow(task, PATHS)


def _visits(bounded: DataFrame, tree: Tree, visits: int, held: dict[int, int], least: int, radii: dict[int, float], first: int) -> DataFrame:
    """(key, vec, leaves, bound): the leaves after the first ones, as far as the bound lets them matter."""
    sent = bounded.sparkSession.sparkContext.broadcast((tree, held, radii))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, held, radii = sent.value
        slack = 1 + 1e-9
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                found = []
                for query, bound in zip(_matrix(part.column("vec")), part.column("bound").to_pylist(), strict=True):
                    path = np.array(_path(tree, query, visits, held, least)[first:], np.int64)
                    if bound is not None and len(path):
                        away = np.sqrt(((tree.centres[path] - query) ** 2).sum(axis=1))
                        path = path[away <= (bound + np.array([radii.get(leaf, -np.inf) for leaf in path.tolist()])) * slack]
                    found.append(path.tolist())
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("vec"), pa.array(found, pa.list_(pa.int32())), part.column("bound")], ["key", "vec", "leaves", "bound"])

    return bounded.select("key", "vec", "bound").mapInArrow(task, PATHS)


def _needed(rows: list[tuple[float, int]], k: int) -> tuple[list[tuple[float, int]], bool]:
    """The first rows that hold ``k`` of other ids whichever id asks, ``k`` of one id at most; and whether they do."""
    out: list[tuple[float, int]] = []
    of_id: dict[int, int] = {}
    most = 0
    for row in rows:
        if len(out) - most >= k:
            break
        if of_id.get(row[1], 0) < k:
            out.append(row)
            of_id[row[1]] = of_id.get(row[1], 0) + 1
            most = max(most, of_id[row[1]])
    return out, len(out) - most >= k


def _compare(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """The nearest vectors of one block of a leaf to one block of its queries, an id a row."""
    vectors, queries = _matrix(left.column("vec").combine_chunks()), _matrix(right.column("vec").combine_chunks())
    ids, keys = left.column("ids").to_pylist(), right.column("key").to_pylist()
    out: list[tuple[str, int, float]] = []
    bounds = right.column("bound").to_numpy(zero_copy_only=False).astype(np.float64)
    bounds = np.where(np.isnan(bounds), np.inf, bounds)
    if len(vectors) and len(queries):
        for q, near, distance in _closest(queries, vectors, k + 1, bounds):
            found, enough = _needed(sorted((d, i) for v, d in zip(near.tolist(), distance.tolist(), strict=True) for i in ids[v]), k)
            if not enough and k < len(near) < len(vectors):
                # Many vectors of one id are in front.
                _, near, distance = next(_closest(queries[q : q + 1], vectors, len(vectors), bounds[q : q + 1]))
                found, _ = _needed(sorted((d, i) for v, d in zip(near.tolist(), distance.tolist(), strict=True) for i in ids[v]), k)
            out += [(keys[q], i, d) for d, i in found]
    return pa.table({"key": strings([x[0] for x in out]), "id": pa.array([x[1] for x in out], pa.int64()), "score": pa.array([x[2] for x in out], pa.float64())})


def _reduced(near: DataFrame, k: int) -> DataFrame:
    """As in a block: a row is needed if less than k of the rows before it are of other ids than the asking one."""
    best = Window.partitionBy("key").orderBy("score", "id")
    near = near.withColumn("n", F.row_number().over(best)).withColumn("of_id", F.row_number().over(Window.partitionBy("key", "id").orderBy("score")))
    most = F.coalesce(F.max("of_id").over(best.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    near = near.withColumn("others", F.col("n") - 1 - most).where((F.col("others") < k) & (F.col("of_id") <= k))
    return near.select("key", "id", "score", "of_id")


def _counts(rows: DataFrame) -> dict[int, int]:
    """Rows per leaf; the tree bounds how many there are."""
    return {r["leaf"]: r["rows"] for r in rows.groupBy("leaf").agg(F.count(F.lit(1)).alias("rows")).collect()}


def _block_count(counts: dict[int, int], most: int):
    """How many blocks a leaf's rows take, as a column over the leaf."""
    many = [F.lit(x) for leaf, rows in counts.items() if rows > most for x in (leaf, -(-rows // most))]
    return F.coalesce(F.element_at(F.create_map(*many), F.col("leaf")), F.lit(1)) if many else F.lit(1)


def _searched(indexed: DataFrame, paths: DataFrame, leaf_rows: dict[int, int], k: int, seed: int) -> DataFrame:
    """(key, id, score): what the leaves of the paths return."""
    visited = paths.select("key", "vec", "bound", F.explode("leaves").alias("leaf"))
    vector_blocks = _block_count(leaf_rows, BLOCK_VECTORS)
    query_blocks = _block_count(_counts(visited), BLOCK_QUERIES)

    def every(blocks):
        return F.explode(F.sequence(F.lit(0), blocks.cast("int") - 1))

    one = F.pmod(F.xxhash64(F.lit(seed), "key"), vector_blocks.cast("long")).cast("int")
    other = F.pmod(F.xxhash64(F.lit(seed), "key"), query_blocks.cast("long")).cast("int")
    left = indexed.withColumn("vblock", one).withColumn("qblock", every(query_blocks))
    right = visited.withColumn("qblock", other).withColumn("vblock", every(vector_blocks))
    by = ["leaf", "vblock", "qblock"]
    pairs = left.groupBy(*by).cogroup(right.groupBy(*by))
    return pairs.applyInArrow(lambda a, b: _compare(a, b, k), "key string, id long, score double")


def nearest(rows: DataFrame, is_query, k: int = 10, key: str = "vec_id", vector: str = "embedding", target: float = TARGET_RECALL, seed: int = 17) -> DataFrame:
    """The k nearest rows of every row that fulfils ``is_query`` (a condition on ``key``).

    Columns: query_id, rank (from 1), the key's name, score (Euclidean distance in
    double precision on the original vectors), leaves_visited.
    """
    valid = valid_vectors(rows, key, vector)
    plain = write_scratch(_classes(valid, k + 1), "vectors")
    asked = valid.where(is_query(F.col("id"))).select("id", "key").distinct()
    total = plain.count()
    length = plain.select(F.size("vec").alias("n")).first()
    wanted = max(1, FIT_VALUES // (length["n"] if length else 1))
    sample = _matrix(plain.where(hash_below(["key"], sample_share(total, wanted), seed)).select("vec").toArrow().column("vec").combine_chunks())
    tree = grow_tree(sample if sample.size else np.zeros((0, length["n"] if length else 1)))
    indexed = write_scratch(_with_leaf(plain, tree), "leaves")
    queries = write_scratch(indexed.join(asked.select("key").distinct(), "key", "left_semi").select("key", "vec"), "queries")
    visits = _calibrate(indexed, queries, tree, k, target, seed + 1)
    leaf_rows = _counts(indexed)
    without_bound = min(FIRST_LEAVES, visits)
    first = write_scratch(_first_visits(queries, tree, without_bound), "first_paths")
    near = write_scratch(_reduced(_searched(indexed, first, leaf_rows, k, seed), k), "first_near")
    enough = F.count(F.lit(1)) - F.max("of_id") >= k
    bounds = near.groupBy("key").agg(F.when(enough, F.max("score")).alias("bound"))
    bounded = queries.join(bounds, "key", "left")
    paths = write_scratch(_visits(bounded, tree, visits, _held(indexed), k + 1, _radii(indexed, tree), without_bound), "paths")
    near = near.drop("of_id").unionByName(_searched(indexed, paths, leaf_rows, k, seed))
    near = _reduced(near, k).drop("of_id")
    both = first.select("key", "leaves").unionByName(paths.select("key", "leaves"))
    near = near.join(both.groupBy("key").agg(F.sum(F.size("leaves")).cast("int").alias("leaves_visited")), "key")
    order = Window.partitionBy("query_id", "key").orderBy("score", "id")
    return (
        asked.withColumnRenamed("id", "query_id")
        .join(near, "key")
        .where(F.col("id") != F.col("query_id"))
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", F.col("id").alias(key), "score", "leaves_visited")
    )
