"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is fitted on a bounded sample and indexes every vector. A query visits leaves
best bin first, through a priority queue over the branches not yet taken. How many leaves
are visited is widened until the recall measured against brute force reaches its target.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandlake.llm.rows import Batches, draw, in_batches, per_batch, written

NEIGHBOURS = 20
RECALL = 0.94
BRANCHES = 8
# Vectors in a leaf as the tree is laid out, sampled vectors per leaf, and most numbers in the sample.
LEAF = 256
PER_LEAF = 24
SAMPLE_NUMBERS = 2_000_000
CALIBRATION = 200
# Vectors that are compared at a time: neighbouring leaves share a shelf, and larger leaves have several.
SHELF = 4096
_GROUP = 512


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` and ``vector`` (doubles) of the vectors that take part, one for each identifier.

    Left out are null identifiers, vectors that are null, zero or hold null or non-finite
    components, and those of another dimension than most have (the smaller on a tie). Of
    rows that share an identifier the smallest vector counts.
    """
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists("vector", lambda x: x != 0)
    good = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite & some)
    sizes = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    good = good.where(F.size("vector") == (sizes[0]["n"] if sizes else 0))
    return good.groupBy("vec_id").agg(F.min("vector").alias("vector"))


@dataclass
class Tree:
    """Inner nodes with the centres of their branches; a child below zero is leaf ``-1 - child``."""

    centres: list[np.ndarray]
    children: list[list[int]]
    leaves: int

    def leaf_of(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row, by descent to the nearest centre."""
        leaf = np.zeros(len(rows), np.int64)
        waiting = [(0, np.arange(len(rows)))] if self.centres else []
        while waiting:
            node, chosen = waiting.pop()
            nearest = _distances(rows[chosen], self.centres[node]).argmin(axis=1)
            for branch, child in enumerate(self.children[node]):
                part = chosen[nearest == branch]
                if len(part) and child < 0:
                    leaf[part] = -1 - child
                elif len(part):
                    waiting.append((child, part))
        return leaf

    def visits(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves for a query, best bin first."""
        if not self.centres:
            return [0]
        queue, found = [(0.0, 0)], []
        while queue and len(found) < most:
            _, node = heapq.heappop(queue)
            if node < 0:
                found.append(-1 - node)
                continue
            far = _distances(query[None, :], self.centres[node])[0].tolist()
            for distance, child in zip(far, self.children[node], strict=True):
                heapq.heappush(queue, (distance, child))
        return found


def _distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of all rows to all centres."""
    return (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)[None, :]


def fit_tree(sample: np.ndarray, leaves: int, branches: int = BRANCHES, seed: int = 7) -> Tree:
    """Split the sample by k-means, and its parts again, until there are about ``leaves`` of them."""
    tree = Tree([], [], 0)
    if leaves < 2 or len(sample) < 2 * branches:
        tree.leaves = 1
        return tree
    rng = np.random.default_rng(seed)
    largest = max(1, len(sample) // leaves)

    def split(rows: np.ndarray) -> int:
        centres = _kmeans(rows, min(branches, max(2, -(-len(rows) // largest))), rng) if len(rows) > largest else rows[:1]
        if len(centres) < 2:
            tree.leaves += 1
            return -tree.leaves
        node = len(tree.centres)
        tree.centres.append(centres)
        tree.children.append([])
        nearest = _distances(rows, centres).argmin(axis=1)
        tree.children[node] = [split(rows[nearest == b]) for b in range(len(centres))]
        return node

    root = split(sample)
    if root < 0:  # all equal
        return Tree([], [], 1)
    return tree


def _kmeans(rows: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 10) -> np.ndarray:
    distinct = np.unique(rows, axis=0)
    if len(distinct) < 2:
        return distinct
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        nearest = _distances(rows, centres).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, rows)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    used = np.unique(_distances(rows, centres).argmin(axis=1))
    return centres[used]


# --------------------------------------------------------------- comparison


def best_of(queries: np.ndarray, own: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place of the query, identifier and inner product of the ``k`` best rows for each query, itself left out.

    A matrix product finds all rows that can be among the best; their products are then
    summed one by one, so that equal vectors get equal scores wherever they lie.
    """
    rough = queries @ rows.T
    rough[own[:, None] == ids[None, :]] = -np.inf
    least = np.full(len(queries), -np.inf)
    if rough.shape[1] > k:
        least = np.partition(rough, -k, axis=1)[:, -k]
    scale = np.sqrt((queries**2).sum(axis=1)) * np.sqrt((rows**2).sum(axis=1).max())
    at, row = np.nonzero((rough >= (least - 1e-9 * scale)[:, None]) & (rough > -np.inf))
    score = (queries[at] * rows[row]).sum(axis=1)
    order = np.lexsort((ids[row], -score, at))
    at, row, score = at[order], row[order], score[order]
    turn = np.arange(len(at)) - np.searchsorted(at, at, side="left")
    kept = turn < k
    return at[kept], ids[row[kept]], score[kept]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _answers(parts: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    columns = []
    for i, name in enumerate(names):
        kind = np.float64 if name == "score" else np.int64
        columns.append(pa.array(np.concatenate([np.empty(0, kind), *[p[i].astype(kind) for p in parts]])))
    return pa.RecordBatch.from_arrays(columns, names)


def _brute(vectors: DataFrame, ids: np.ndarray, queries: np.ndarray, tree: Tree, lift: float, k: int) -> DataFrame:
    """The ``k`` best of each task's vectors for a bounded number of queries, with their leaves."""

    def run(batches: Batches) -> Batches:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, own = _matrix(batch.column("vector")), batch.column("vec_id").to_numpy()
            at, vec, score = best_of(queries, ids, rows, own, k)
            order = np.argsort(own)
            leaf = tree.leaf_of(lifted(rows[order[np.searchsorted(own, vec, sorter=order)]], lift))
            found = [np.concatenate([h, n]) for h, n in zip(held, (at, vec, score, leaf), strict=True)] if held else [at, vec, score, leaf]
            order = np.lexsort((found[1], -found[2], found[0]))
            found = [f[order] for f in found]
            turn = np.arange(len(order)) - np.searchsorted(found[0], found[0], side="left")
            held = [f[turn < k] for f in found]
        if held:
            yield _answers([(ids[held[0]], held[1], held[2], held[3])], ["query_id", "vec_id", "score", "leaf"])

    return in_batches(vectors, run, "query_id long, vec_id long, score double, leaf long")


def lifted(rows: np.ndarray, lift: float) -> np.ndarray:
    """Rows with one more component that gives all of them the length ``lift``: the largest
    inner product is then the smallest distance."""
    rest = np.sqrt(np.maximum(0.0, lift**2 - (rows**2).sum(axis=1)))
    return np.concatenate([rows, rest[:, None]], axis=1)


def raised(queries: np.ndarray, lift: float) -> np.ndarray:
    """Queries at the length ``lift``, with a last component of zero."""
    sizes = np.sqrt((queries**2).sum(axis=1))[:, None]
    return np.concatenate([queries * (lift / sizes), np.zeros((len(queries), 1))], axis=1)


def _ranked(answers: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


# ----------------------------------------------------------------- operator


@dataclass
class Plan:
    tree: Tree
    lift: float
    visits: int
    recall: float  # as measured on the calibration queries


def plan(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS, target: float = RECALL) -> Plan | None:
    """Fit the tree and calibrate how many leaves to visit; None without vectors."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x))
    facts = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("lift"), F.max(F.size("vector")).alias("dim")).first()
    if not facts["n"]:
        return None
    most = max(1, SAMPLE_NUMBERS // facts["dim"])
    at = draw(F.col("vec_id"), "tree")
    sampled = vectors.where(at < min(1.0, 0.9 * most / facts["n"])).orderBy(at, "vec_id").limit(most).select("vector").collect()
    lift = float(facts["lift"])
    sample = lifted(np.array([r["vector"] for r in sampled], float).reshape(-1, facts["dim"]), lift)
    tree = fit_tree(sample, min(facts["n"] // LEAF, len(sample) // PER_LEAF))
    chosen = queries.orderBy(draw(F.col("vec_id"), "calibration"), "vec_id").limit(CALIBRATION).collect()
    if not chosen or tree.leaves < 2:
        return Plan(tree, lift, tree.leaves, 1.0)
    ids = np.array([r["vec_id"] for r in chosen])
    rows = np.array([r["vector"] for r in chosen], float)
    truth = _ranked(_brute(vectors, ids, rows, tree, lift, k), k).select("query_id", "leaf").collect()
    order = {i: tree.visits(q, tree.leaves) for i, q in zip(ids.tolist(), raised(rows, lift), strict=True)}
    turn = {i: {leaf: n for n, leaf in enumerate(leaves, 1)} for i, leaves in order.items()}
    needed = np.sort([turn[r["query_id"]][r["leaf"]] for r in truth])
    if not len(needed):
        return Plan(tree, lift, tree.leaves, 1.0)
    visits = int(needed[min(len(needed) - 1, int(np.ceil(target * len(needed))) - 1)])
    return Plan(tree, lift, visits, float((needed <= visits).mean()))


def nearest(vectors: DataFrame, every: int = 20, k: int = NEIGHBOURS, target: float = RECALL) -> DataFrame:
    """The ``k`` nearest rows found for each row whose ``vec_id`` is divisible by ``every``.

    Returns ``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the inner product in
    double precision of the original vectors, largest first, ties to the smaller
    identifier; all candidates, if there are fewer than ``k``. Vectors that ``usable``
    leaves out take no part, neither as query nor as candidate. A table without usable
    vectors gives no rows.

    Of equal vectors only those with the ``k + 1`` smallest identifiers are compared,
    since no others can be among the ``k`` best of any query.
    """
    spark = vectors.sparkSession
    rows = written(usable(vectors), "vectors")
    equal = Window.partitionBy("vector").orderBy("vec_id")
    listed = rows.withColumn("turn", F.row_number().over(equal)).where(F.col("turn") <= k + 1).drop("turn")
    listed = written(listed, "listed")
    queries = rows.where(F.col("vec_id") % every == 0)
    made = plan(listed, queries, k, target)
    if made is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree, lift, visits = made.tree, made.lift, made.visits

    def placed():
        def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = tree.leaf_of(lifted(_matrix(batch.column("vector")), lift))
            return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("vector"), pa.array(found)], ["vec_id", "vector", "leaf"])

        return apply

    indexed = written(per_batch(listed, placed, "vec_id long, vector array<double>, leaf long"), "leaves")
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}
    first, many = shelves([sizes.get(leaf, 0) for leaf in range(tree.leaves)])

    def at_leaf(numbers: list[int]) -> Column:
        return F.element_at(F.lit(numbers).cast("array<bigint>"), (F.col("leaf") + 1).cast("int"))

    shelf = at_leaf(first) + F.pmod(F.xxhash64("vec_id", F.lit("shelf")), at_leaf(many))
    nothing = F.lit(float("-inf"))
    stored = indexed.select("vec_id", "vector", shelf.alias("shelf"), nothing.alias("floor"), F.lit(0).alias("kind"))

    def asked(queries: DataFrame, opening: bool) -> DataFrame:
        """A row for each query and shelf: the first one it visits, or all others."""

        def make():
            def apply(batch: pa.RecordBatch) -> pa.RecordBatch:
                places, visited = [], []
                for at, query in enumerate(raised(_matrix(batch.column("vector")), lift)):
                    leaves = tree.visits(query, visits)
                    found = list(dict.fromkeys(s for leaf in leaves for s in range(first[leaf], first[leaf] + many[leaf])))
                    chosen = found[:1] if opening else found[1:]
                    places += [at] * len(chosen)
                    visited += chosen
                rows = batch.take(pa.array(places, pa.int64()))
                columns = [rows.column("vec_id"), rows.column("vector"), pa.array(visited, pa.int64()), rows.column("floor")]
                return pa.RecordBatch.from_arrays(columns, ["vec_id", "vector", "shelf", "floor"])

            return apply

        return per_batch(queries, make, "vec_id long, vector array<double>, shelf long, floor double").withColumn("kind", F.lit(1))

    def compared(questions: DataFrame) -> DataFrame:
        met = stored.unionByName(questions).repartition("shelf").sortWithinPartitions("shelf", "kind")
        return in_batches(met, partial(_compare, k=k), "query_id long, vec_id long, score double")

    # the first shelf gives each query a score that the others have to reach
    opened = written(compared(asked(queries.withColumn("floor", nothing), True)), "opened")
    floors = opened.groupBy(F.col("query_id").alias("vec_id")).agg(
        F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(nothing).alias("floor")
    )
    rest = queries.join(floors, "vec_id", "left").select("vec_id", "vector", F.coalesce("floor", nothing).alias("floor"))
    answers = opened.unionByName(compared(asked(rest, False)))
    return _ranked(answers, k).select("query_id", "rank", "vec_id", "score")


def shelves(sizes: list[int], most: int = SHELF) -> tuple[list[int], list[int]]:
    """First shelf and number of shelves of each leaf, by the number of vectors in it."""
    first, many, shelf, filled = [], [], 0, 0
    for size in sizes:
        if filled and filled + size > most:
            shelf, filled = shelf + 1, 0
        parts = max(1, -(-size // most))
        first.append(shelf)
        many.append(parts)
        shelf += parts - 1
        filled = most if parts > 1 else filled + size
    return first, many


def _compare(batches: Batches, k: int) -> Batches:
    """Answers of each shelf, whose vectors come before the queries that visit it.

    The vectors of one shelf are held, queries are compared as they come.
    """
    key, rows, ids = None, [], []
    for batch in batches:
        shelf, kind, own, floor = (batch.column(c).to_numpy() for c in ("shelf", "kind", "vec_id", "floor"))
        if not len(own):
            continue
        matrix, out = _matrix(batch.column("vector")), []
        cuts = np.flatnonzero((shelf[1:] != shelf[:-1]) | (kind[1:] != kind[:-1])) + 1
        for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)], strict=True):
            if key != shelf[low]:
                key, rows, ids = shelf[low], [], []
            if kind[low] == 0:
                rows.append(matrix[low:high])
                ids.append(own[low:high])
                continue
            if len(rows) > 1:
                rows, ids = [np.concatenate(rows)], [np.concatenate(ids)]
            for start in range(low, high, _GROUP) if rows else ():
                end = min(high, start + _GROUP)
                at, vec, score = best_of(matrix[start:end], own[start:end], rows[0], ids[0], k)
                good = score >= floor[start:end][at]
                out.append((own[start:end][at[good]], vec[good], score[good]))
        yield _answers(out, ["query_id", "vec_id", "score"])
