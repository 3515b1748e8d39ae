"""Approximate nearest neighbours by inner product: forests of random-projection trees, one queue over all trees of a forest."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indicatorlake.session import written

from .common import ship

NEAREST = 20
#: Vectors of a page, the part of the space that one forest covers, and pages a query enters.
PAGE_ROWS, PROBES = 8192, 16
TREES, LEAF_ROWS = 32, 64
#: Rows of leaves a query looks at over all its pages, copies of a row in several trees included.
LOOKED_AT = 28_000
#: Vectors the tree over pages is fitted on: so many a page, and never more than MOST_SAMPLED.
SAMPLED, MOST_SAMPLED, LEAST_SAMPLED = 64, 65_536, 16
#: Queries that one task takes through a page.
QUERY_ROWS = 16_384
#: Rows of a split that its two centres are drawn from.
CENTRED = 64
SALTS = 64


@dataclass
class Tree:
    """Inner node k sends a vector right where vector @ normals[k] > cuts[k]; a child below 0 is leaf -child - 1."""

    normals: np.ndarray
    cuts: np.ndarray
    children: list[tuple[int, int]]
    root: int
    leaves: list[np.ndarray]


def _lifted(vectors: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more coordinate, so that all are ``longest`` long and the largest inner product is the smallest angle."""
    rest = np.maximum(longest**2 - np.einsum("ij,ij->i", vectors, vectors), 0)
    return np.column_stack([vectors, np.sqrt(rest)]) / longest


def _aimed(queries: np.ndarray) -> np.ndarray:
    """Queries as unit vectors without a share in the added coordinate."""
    scaled = queries / np.abs(queries).max(axis=1, keepdims=True)
    return np.column_stack([scaled / np.linalg.norm(scaled, axis=1, keepdims=True), np.zeros(len(queries))])


def plant(points: np.ndarray, leaf_rows: int, rng: np.random.Generator) -> Tree:
    """A tree over all points.

    A node projects its points on the line through two centres, drawn from a random
    few of them, and halves them at the median, so that every tree is as deep as the
    logarithm of its points; points that fall on one spot are halved by place.
    """
    normals, cuts, children, leaves = [], [], [], []

    def grow(rows: np.ndarray) -> int:
        if len(rows) <= leaf_rows:
            leaves.append(rows)
            return -len(leaves)
        drawn = points[rng.choice(rows, min(len(rows), CENTRED))]
        one, two = drawn[rng.integers(0, len(drawn), 2)]
        for _ in range(3):
            nearer = drawn @ (two - one) > (two @ two - one @ one) / 2
            if not nearer.any() or nearer.all():
                break
            one, two = drawn[~nearer].mean(axis=0), drawn[nearer].mean(axis=0)
        normal = two - one
        length = np.linalg.norm(normal)
        normal = normal / length if length > 0 else rng.standard_normal(points.shape[1]) / math.sqrt(points.shape[1])
        along = points[rows] @ normal
        half = np.argsort(along, kind="stable")
        low, high = rows[half[: len(rows) // 2]], rows[half[len(rows) // 2 :]]
        node = len(children)
        normals.append(normal)
        cuts.append(along[half[len(rows) // 2 - 1]])
        children.append((0, 0))
        children[node] = grow(low), grow(high)
        return node

    root = grow(np.arange(len(points)))
    width = points.shape[1]
    return Tree(np.array(normals).reshape(-1, width), np.array(cuts), children, root, leaves)


def entered(forest: list[Tree], margins: list[list[float]], enough: int, size) -> Iterator[tuple[int, int]]:
    """The leaves (tree, leaf) of a forest in the order of one queue over all trees, until their sizes sum to ``enough``.

    The queue holds the branches not taken so far, each with the squared distances to
    the planes that part it from the query; from the nearest branch a walk goes down
    to a leaf and leaves the other branches in the queue.
    """
    queue = [(0.0, t, tree.root) for t, tree in enumerate(forest)]
    seen = 0
    while queue and seen < enough:
        far, t, node = heapq.heappop(queue)
        children, margin = forest[t].children, margins[t]
        while node >= 0:
            side = margin[node]
            near, other = children[node] if side <= 0 else children[node][::-1]
            heapq.heappush(queue, (far + side * side, t, other))
            node = near
        seen += size(t, -node - 1)
        yield t, -node - 1


def _margins(forest: list[Tree], aimed: np.ndarray) -> list[np.ndarray]:
    return [aimed @ tree.normals.T - tree.cuts for tree in forest]


def _products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed from the first component to the last."""
    total = np.zeros(len(rows))
    for k in range(len(query)):
        total += rows[:, k] * query[k]
    return total


def search(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, most: int, looked_at: int,
           trees: int = TREES, leaf_rows: int = LEAF_ROWS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every query the places and scores of the best vectors in the leaves it enters, ties to the smaller id."""
    with np.errstate(all="ignore"):
        scale = np.abs(vectors).max()
        scaled = vectors / scale
        points = _lifted(scaled, np.linalg.norm(scaled, axis=1).max())
        rng = np.random.default_rng(42)
        forest = [plant(points, leaf_rows, rng) for _ in range(trees)]
        norms = np.linalg.norm(scaled, axis=1)
        for low in range(0, len(queries), 64):
            block = queries[low : low + 64]
            margins = _margins(forest, _aimed(block))
            for k, query in enumerate(block):
                leaves = [forest[t].leaves[leaf] for t, leaf in entered(
                    forest, [m[k].tolist() for m in margins], looked_at, lambda t, leaf: len(forest[t].leaves[leaf]))]
                marked = np.zeros(len(vectors), bool)
                marked[np.concatenate(leaves)] = True
                rows = np.flatnonzero(marked)
                top = np.abs(query).max()
                rough = scaled[rows] @ (query / top)
                if len(rows) > most:  # what rounding may still lift among the best stays
                    edge = np.partition(rough, len(rough) - most)[len(rough) - most]
                    slack = 1e-12 * np.linalg.norm(query / top) * norms.max()
                    rows = rows[rough >= edge - slack]
                scores = np.nan_to_num(_products(query, vectors[rows]), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
                order = np.lexsort((ids[rows], -scores))[:most]
                yield rows[order], scores[order]


def _matrix(lists: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of numbers, shorter ones filled with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
    out = np.zeros((len(lists), width))
    row = np.repeat(np.arange(len(lists)), sizes)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _placed(vectors: DataFrame, pages: Tree | None, width: int, longest: float) -> DataFrame:
    """Every vector with the page whose leaf it falls into."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page = np.zeros(batch.num_rows, np.int64)
            if pages and batch.num_rows:
                points = _lifted(_matrix(batch.column("vector"), width) / longest, 1.0)
                node = np.full(batch.num_rows, pages.root)
                children = np.array(pages.children)
                while (inner := np.flatnonzero(node >= 0)).size:
                    at = node[inner]
                    right = np.einsum("ij,ij->i", points[inner], pages.normals[at]) > pages.cuts[at]
                    node[inner] = children[at, right.astype(int)]
                page = -node - 1
            yield batch.append_column("page", pa.array(page))

    return vectors.mapInArrow(run, "h array<long>, first long, vector array<double>, page long")


def _sent(queries: DataFrame, pages: Tree | None, width: int, probes: int) -> DataFrame:
    """Every query once for each page it enters, with the number of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [[0]] * batch.num_rows
            if pages and batch.num_rows:
                margins = _margins([pages], _aimed(_matrix(batch.column("vector"), width)))[0]
                lists = [[leaf for _, leaf in entered([pages], [m.tolist()], probes, lambda t, leaf: 1)] for m in margins]
            yield batch.append_column("pages", pa.array(lists, pa.list_(pa.int64())))

    sent = queries.select("h", "vector").mapInArrow(run, "h array<long>, vector array<double>, pages array<long>")
    return sent.select("h", "vector", F.explode("pages").alias("page"), F.size("pages").alias("entered"))


def _searched(nearest: int, width: int, looked_at: int):
    def run(key: tuple[pa.Scalar, ...], page: pa.Table, asked: pa.Table) -> pa.Table:
        out = {"q": [], "h": [], "first": [], "score": []}
        if page.num_rows and asked.num_rows:
            page = page.sort_by("first")  # however the rows arrive, the forest is the same
            vectors, ids = _matrix(page["vector"], width), page["first"].to_numpy()
            share = looked_at // (asked["entered"][0].as_py() * page["parts"][0].as_py())
            found = search(vectors, ids, _matrix(asked["vector"], width), nearest + 1, share)
            for place, (rows, scores) in enumerate(found):
                out["q"].append(np.full(len(rows), place))
                out["h"].append(rows)
                out["first"].append(ids[rows])
                out["score"].append(scores)
        parts = {n: np.concatenate(v) if v else np.zeros(0, np.float64 if n == "score" else np.int64) for n, v in out.items()}
        return pa.table({"q": asked["h"].take(pa.array(parts["q"])), "h": page["h"].take(pa.array(parts["h"])),
                         "first": pa.array(parts["first"]), "score": pa.array(parts["score"])})

    return run


def _usable(vector: Column) -> Column:
    return (vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(vector, lambda x: x != 0))


def _pages_for(vectors: DataFrame, rows: int, width: int, longest: float) -> Tree | None:
    """A tree whose leaves are the pages, fitted on a bounded sample; None where one page holds all."""
    wanted = min(1 << max(0, math.ceil(math.log2(max(rows, 1) / PAGE_ROWS))), MOST_SAMPLED // LEAST_SAMPLED)
    if wanted == 1:
        return None
    sample = vectors.orderBy("h").limit(min(wanted * SAMPLED, MOST_SAMPLED)).select("vector").toArrow()
    points = _lifted(_matrix(sample["vector"], width) / longest, 1.0)
    return plant(points, max(1, math.ceil(len(points) / wanted)), np.random.default_rng(7))


def nearest_neighbours(rows: DataFrame, queries: Column | str, id_column: str = "vec_id", vector: str = "embedding", nearest: int = NEAREST,
                       probes: int = PROBES, looked_at: int = LOOKED_AT) -> DataFrame:
    """(query_id, rank, vec_id, score) of the rows found nearest to every row that meets ``queries``.

    Nearness is the inner product, in double precision; rank 1 is the largest, ties
    go to the smaller id.  Fewer rows than ``nearest`` come back only if the pages a
    query enters hold fewer.

    Equal vectors are one vector (known by 128 bits of hash) with its ``nearest + 1``
    smallest ids, which is all that a result can name.  A tree fitted on at most
    ``MOST_SAMPLED`` vectors deals all of them to pages; a page gets a forest over all
    its rows, and a query enters ``probes`` pages and looks at ``looked_at`` rows of
    leaves over all of them, so that the work is in proportion to the queries.  Pages
    and queries beyond a task's share are cut into parts that all meet.

    Null, empty and zero vectors, vectors with a null or non-finite component, and rows
    without an id take no part; shorter vectors count as filled up with zeros.  Rows
    equal in id and vector are one row; a query does not find rows of its own id.  An
    empty table gives no rows; other columns are not read.
    """
    spark = rows.sparkSession
    ship(spark)
    wanted = F.expr(queries) if isinstance(queries, str) else queries
    # 0.0 + x makes -0.0 equal to 0.0
    plain = rows.select(rows[id_column].cast("long").alias("id"), F.coalesce(wanted, F.lit(False)).alias("asks"),
                        F.transform(rows[vector].cast("array<double>"), lambda x: F.lit(0.0) + x).alias("vector"))
    plain = plain.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    hashed = plain.withColumn("h", F.array(F.xxhash64(F.lit(1), "vector"), F.xxhash64(F.lit(2), "vector")))

    named = hashed.groupBy("h", "id").agg(F.max("asks").alias("asks"))
    some = named.select("h", "id", (F.xxhash64("id") % SALTS).alias("salt"))
    for by in (["h", "salt"], ["h"]):  # the ids of one hot vector first in parts
        some = some.withColumn("place", F.row_number().over(Window.partitionBy(*by).orderBy("id"))).where(F.col("place") <= nearest + 1).drop("place")
    ids = written(some.groupBy("h").agg(F.sort_array(F.collect_list("id")).alias("ids")), "ids")
    asking = written(named.where("asks").select("h", "id"), "asking")
    distinct = written(hashed.groupBy("h").agg(F.min("id").alias("first"), F.first("vector").alias("vector")), "vectors")

    norm = F.sqrt(F.aggregate(F.transform("vector", lambda x: x * x), F.lit(0.0), lambda s, x: s + x))
    facts = distinct.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("width"), F.max(norm).alias("longest")).first()
    width, longest = facts["width"] or 1, facts["longest"] or 1.0
    pages = _pages_for(distinct, facts["n"], width, longest)

    placed = written(_placed(distinct, pages, width, longest), "placed")
    sent = written(_sent(distinct.join(asking.select("h").distinct(), "h", "left_semi"), pages, width, probes), "sent")
    parts = placed.groupBy("page").agg(F.ceil(F.count("*") / F.lit(2 * PAGE_ROWS)).cast("int").alias("parts")).join(
        sent.groupBy("page").agg(F.ceil(F.count("*") / F.lit(QUERY_ROWS)).cast("int").alias("copies")), "page")
    parts = written(parts, "parts")
    left = placed.join(parts, "page").select("page", (F.pmod(F.xxhash64("h"), "parts")).cast("int").alias("part"), "parts",
                                             F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"), "h", "first", "vector")
    right = sent.join(parts, "page").select("page", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
                                            (F.pmod(F.xxhash64("h"), "copies")).cast("int").alias("copy"), "h", "vector", "entered")
    met = left.groupBy("page", "part", "copy").cogroup(right.groupBy("page", "part", "copy")).applyInArrow(
        _searched(nearest, width, looked_at), "q array<long>, h array<long>, first long, score double")
    # at most nearest + 1 of every page entered
    best = met.groupBy("q").agg(F.collect_list(F.struct((-F.col("score")).alias("order"), "first", "h")).alias("all")).select(
        "q", F.explode(F.slice(F.array_sort("all"), 1, nearest + 1)).alias("b"))
    answers = best.select("q", "b.order", "b.h").join(ids, "h").select("q", "order", F.explode("ids").alias("id"))
    answers = answers.groupBy("q").agg(F.slice(F.array_sort(F.collect_list(F.struct("order", "id"))), 1, nearest + 1).alias("found"))
    own = asking.join(answers, asking["h"] == answers["q"]).select(
        F.col("id").alias("query_id"), F.slice(F.filter("found", lambda x: x["id"] != F.col("id")), 1, nearest).alias("found"))
    return own.select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("f.id").alias("vec_id"), (F.lit(0.0) - F.col("f.order")).alias("score"))
