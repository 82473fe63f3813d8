"""Exact top-k by inner product through a paged M-tree, one subtree per shard."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import written

# Entries of a node at most; vectors of a shard, about; queries of a block, about
PAGE = 64
SHARD_ROWS = 8192
BLOCK_QUERIES = 1024
# Routing objects of the top level, drawn by hash: a bounded sample that fits the shards
TOP_PIVOTS = 64
# Integer sums up to here are exact in double precision
_EXACT = 2.0**53
# Room for rounding in distances, relative to the numbers they come from
_SLACK = 1e-9


def quantized(df: DataFrame, vector: str, scale: int = 256) -> Column:
    """floor(scale * x) of each component as double; null unless all are finite."""
    ok = F.forall(
        vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))
    )
    return F.when(ok, F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double")))


def usable(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, width, q) of the vectors that take part."""
    return (
        vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), quantized(vectors, vector).alias("q"))
        .filter(F.col("vec_id").isNotNull() & (F.size("q") > 0))
        .select("vec_id", F.size("q").alias("width"), "q")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), width)


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors with one more component that makes all norms equal to ``top``'s root.

    Among such vectors the nearest to a query (lifted by 0) has the largest inner product, so
    a metric tree over them answers inner-product queries.
    """
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0.0))
    return np.hstack([x, rest[:, None]])


def _to(points: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((points - center) ** 2).sum(axis=1), 0.0))


def build_nodes(points: np.ndarray, page: int = PAGE) -> list[dict]:
    """The M-tree of lifted points as pages, the root first.

    A node that holds more than a page is split by the generalized hyperplane between up to
    ``page`` far-apart routing objects. A node has its routing object's row, covering radius,
    distance to the parent's routing object, its children or, in a leaf, its entries with
    their distances to the routing object.
    """
    nodes: list[dict] = []
    todo = [(np.arange(len(points)), 0, -1, 0.0)]
    while todo:
        rows, center, parent, parent_distance = todo.pop()
        distance = _to(points[rows], points[center])
        node = {"center": center, "parent": parent, "parent_distance": parent_distance,
                "radius": float(distance.max()), "rows": rows, "distance": distance, "leaf": True}
        number = len(nodes)
        nodes.append(node)
        if len(rows) <= page or node["radius"] == 0.0:
            continue
        fan = int(min(page, -(-len(rows) // (page // 2)), 16))
        chosen, nearest, owner = [center], distance.copy(), np.zeros(len(rows), np.int64)
        for k in range(1, fan):
            far = int(nearest.argmax())
            if nearest[far] == 0.0:
                break
            chosen.append(int(rows[far]))
            new = _to(points[rows], points[rows[far]])
            closer = new < nearest
            nearest[closer], owner[closer] = new[closer], k
        node["leaf"] = False
        node["rows"], node["distance"] = None, None
        for k, c in enumerate(chosen):
            own = rows[owner == k]
            todo.append((own, c, number, float(_to(points[c][None, :], points[center])[0])))
    return nodes


def _scores(x: np.ndarray, y: np.ndarray, largest: float) -> np.ndarray:
    """Inner products of rows of whole numbers as int64, exact; ``largest`` bounds their size."""
    if largest < _EXACT:
        return (x @ y.T).astype(np.int64)
    if largest >= 2.0**62:
        raise OverflowError("inner products of these vectors do not fit in 64 bits")
    return x.astype(np.int64) @ y.astype(np.int64).T


class Tree:
    """A shard's pages, searched best first for a block of queries with the stored bounds."""

    def __init__(self, pages: pa.Table, width: int):
        arrays = lambda name, kind: [np.asarray(v, kind) for v in pages[name].to_numpy()]
        self.ids, self.distance = arrays("ids", np.int64), arrays("distances", np.float64)
        self.vectors = [v.reshape(-1, width) for v in arrays("vectors", np.float64)]
        self.center = np.vstack(arrays("center", np.float64))
        self.radius, self.parent_distance = pages["radius"].to_numpy(), pages["parent_distance"].to_numpy()
        place = {n: i for i, n in enumerate(pages["node"].to_pylist())}
        parents = [place.get(p, -1) for p in pages["parent"].to_pylist()]
        self.root = parents.index(-1)
        self.kids = {p: np.flatnonzero(np.asarray(parents) == p) for p in set(parents) - {-1}}
        self.top = float(pages["top"].to_numpy()[0])

    def _leaves(self, lifted: np.ndarray, limit: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(leaf, queries, distances, lower bounds) of what a query may have to look at."""
        first = _to(lifted, self.center[self.root])
        todo, found = [(self.root, np.arange(len(lifted)), first)], []
        while todo:
            node, rows, distance = todo.pop()
            if node not in self.kids:
                found.append((node, rows, distance, np.maximum(distance - self.radius[node], 0.0)))
                continue
            for kid in self.kids[node]:
                # The stored parent distance rules out a child before its own distance is computed
                near = np.abs(distance - self.parent_distance[kid]) - self.radius[kid] <= limit[rows]
                rows_near = rows[near]
                own = _to(lifted[rows_near], self.center[kid])
                reached = own - self.radius[kid] <= limit[rows_near]
                if reached.any():
                    todo.append((int(kid), rows_near[reached], own[reached]))
        return found

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row of the query, vec_id, score) of each query's ``k`` best with a score of ``floor`` at least.

        Rows with the query's own vec_id are no candidates. Every query looks first into the leaf with its
        smallest bound; leaves then come by their smallest bound, each with the queries that still reach it.
        """
        norm = np.einsum("ij,ij->i", queries, queries)
        lifted = np.hstack([queries, np.zeros((len(queries), 1))])
        slack = _SLACK * (self.top + norm + 1.0)
        largest = float(np.sqrt(norm.max(initial=0.0) * self.top)) * 1.001
        worst = floor.astype(np.float64)  # the score that a candidate has to reach by now
        rows = np.zeros(0, np.int64)
        ids, scores = rows.copy(), rows.copy()

        def reach(at: np.ndarray) -> np.ndarray:
            """Largest distance at which a point can still enter, ties included."""
            return np.sqrt(np.maximum(norm[at] + self.top - 2.0 * worst[at], 0.0) + slack[at]) + slack[at] ** 0.5 * 1e-3

        def visit(leaf: int, at: np.ndarray, distance: np.ndarray) -> None:
            nonlocal rows, ids, scores
            value = _scores(queries[at], self.vectors[leaf], largest)
            fits = np.abs(distance[:, None] - self.distance[leaf][None, :]) <= reach(at)[:, None]
            fits &= (value >= worst[at][:, None]) & (self.ids[leaf][None, :] != query_ids[at][:, None])
            q, e = np.nonzero(fits)
            if not len(q):
                return
            rows = np.concatenate([rows, at[q]])
            ids = np.concatenate([ids, self.ids[leaf][e]])
            scores = np.concatenate([scores, value[q, e]])
            order = np.lexsort((ids, -scores, rows))
            rows, ids, scores = rows[order], ids[order], scores[order]
            starts = np.searchsorted(rows, rows)
            place = np.arange(len(rows)) - starts
            kept = place < k
            rows, ids, scores, place = rows[kept], ids[kept], scores[kept], place[kept]
            full = place == k - 1
            worst[rows[full]] = np.maximum(worst[rows[full]], scores[full].astype(np.float64))

        leaves = self._leaves(lifted, reach(np.arange(len(queries))))
        nearest, bound = np.full(len(queries), -1), np.full(len(queries), np.inf)
        for number, (_, at, _, low) in enumerate(leaves):
            closer = low < bound[at]
            nearest[at[closer]], bound[at[closer]] = number, low[closer]
        for number, (leaf, at, distance, _) in enumerate(leaves):
            first = nearest[at] == number
            if first.any():
                visit(leaf, at[first], distance[first])
        by_bound = sorted(range(len(leaves)), key=lambda n: float(leaves[n][3].min(initial=np.inf)))
        for number in by_bound:
            leaf, at, distance, low = leaves[number]
            still = (nearest[at] != number) & (low <= reach(at))
            if still.any():
                visit(leaf, at[still], distance[still])
        return rows, ids, scores


_NODES = (
    "shard string, node int, parent int, center array<double>, radius double, "
    "parent_distance double, ids array<bigint>, distances array<double>, vectors array<double>, top double"
)


def _build_shard(table: pa.Table) -> pa.Table:
    shard = table["shard"][0].as_py()
    table = table.sort_by([("vec_id", "ascending")])
    width = table["width"][0].as_py()
    x = _matrix(table["q"].combine_chunks(), width)
    ids = table["vec_id"].to_numpy()
    top = float(table["top"][0].as_py())
    lifted = _lift(x, top)
    rows = []
    for number, node in enumerate(build_nodes(lifted)):
        leaf = node["leaf"]
        own = node["rows"] if leaf else np.zeros(0, np.int64)
        rows.append(
            (shard, number, node["parent"], lifted[node["center"]], node["radius"], node["parent_distance"],
             ids[own], node["distance"] if leaf else np.zeros(0), x[own].ravel(), top)
        )
    types = [pa.string(), pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.float64(), pa.float64(),
             pa.list_(pa.int64()), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
    names = ["shard", "node", "parent", "center", "radius", "parent_distance", "ids", "distances", "vectors", "top"]
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def _nearest_cell(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return ((centers**2).sum(axis=1)[None, :] - 2.0 * (x @ centers.T)).argmin(axis=1)


class Cells(NamedTuple):
    """Routing objects of the top level by width, their norm bound, and how each cell is cut into shards."""

    centers: dict[int, np.ndarray]
    top: dict[int, float]
    parts: dict[tuple[int, int], int]
    radius: dict[tuple[int, int], float]


def build_index(points: DataFrame, k: int) -> tuple[DataFrame, Cells]:
    """All pages of the index, one subtree per shard, as a written table, and its top level.

    ``points`` (vec_id, width, q) is a written table; every row counts, repeated ones too. Of equal vectors only
    ``k`` rows of an id and the 2 ``k`` rows with the smallest ids can ever be among a query's ``k``
    best (ties go to the smaller id, and the query's own id takes ``k`` of them at most), so the others are left
    out exactly; both limits are applied before the shuffle. A vector goes to the nearest of at most ``TOP_PIVOTS``
    routing objects of its width; a cell is dealt on by hash into shards of about ``SHARD_ROWS`` rows.
    """
    one_id = Window.partitionBy("width", "q", "vec_id").orderBy("vec_id")
    same = Window.partitionBy("width", "q").orderBy("vec_id")
    kept = written(
        points.select("vec_id", "width", "q")
        .withColumn("_r", F.row_number().over(one_id)).filter(F.col("_r") <= k)
        .withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= 2 * k).drop("_r"),
        "mtree-points",
    )
    norm = F.aggregate("q", F.lit(0.0), lambda a, x: a + x * x)
    widths = kept.groupBy("width").agg(F.max(norm).alias("top"))
    draw = Window.partitionBy("width").orderBy(F.xxhash64("vec_id"), "vec_id")
    drawn = (
        kept.withColumn("_r", F.row_number().over(draw)).filter(F.col("_r") <= TOP_PIVOTS).drop("_r")
        .join(widths, "width").select("width", "q", "top")
    )
    pivots: dict[int, list] = {}
    top: dict[int, float] = {}
    for row in drawn.toLocalIterator():
        pivots.setdefault(row["width"], []).append(row["q"])
        top[row["width"]] = row["top"]
    centers = {w: _lift(np.asarray(q), top[w]) for w, q in pivots.items()}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column(1).to_numpy()
            cell, tops, away = np.zeros(len(width), np.int32), np.zeros(len(width)), np.zeros(len(width))
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                x = _lift(_matrix(batch.column(2).take(pa.array(at)), w), top[w])
                cell[at] = _nearest_cell(x, centers[w])
                away[at] = np.sqrt(((x - centers[w][cell[at]]) ** 2).sum(axis=1))
                tops[at] = top[w]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell), pa.array(tops), pa.array(away)],
                names=["vec_id", "width", "q", "cell", "top", "away"],
            )

    routed = written(
        kept.mapInArrow(route, "vec_id bigint, width int, q array<double>, cell int, top double, away double"),
        "mtree-routed",
    )
    sizes = routed.groupBy("width", "cell").agg(
        F.ceil(F.count("*") / F.lit(SHARD_ROWS)).alias("parts"), F.max("away").alias("radius")
    )
    shard = F.concat_ws(":", "width", "cell", F.pmod(F.xxhash64("vec_id", "q"), "parts"))
    sharded = routed.join(sizes, ["width", "cell"]).select(shard.alias("shard"), "vec_id", "width", "q", "top")
    # At most TOP_PIVOTS rows for each width
    cut = {(r["width"], r["cell"]): (int(r["parts"]), float(r["radius"])) for r in sizes.collect()}
    cells = Cells(centers, top, {c: p for c, (p, _) in cut.items()}, {c: r for c, (_, r) in cut.items()})
    return written(sharded.groupBy("shard").applyInArrow(_build_shard, _NODES), "mtree-nodes"), cells


def _sent(asked: DataFrame, cells: Cells, home: bool) -> DataFrame:
    """Queries with the shards that they are sent to: one at home, then all others whose cell they still reach."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, width, floor = (batch.column(c).to_numpy() for c in ("number", "width", "floor"))
            rows, shards = [np.zeros(0, np.int64)], []
            for w in [w for w in np.unique(width).tolist() if w in cells.centers]:
                at = np.flatnonzero(width == w)
                q, centers = _matrix(batch.column("q").take(pa.array(at)), w), cells.centers[w]
                lifted, norm = np.hstack([q, np.zeros((len(q), 1))]), np.einsum("ij,ij->i", q, q)
                homes = _nearest_cell(lifted, centers)
                slack = _SLACK * (cells.top[w] + norm + 1.0)
                reach = np.sqrt(np.maximum(norm + cells.top[w] - 2.0 * floor[at], 0.0) + slack) + slack**0.5 * 1e-3
                for c in [c for c in range(len(centers)) if (w, c) in cells.parts]:
                    parts = cells.parts[w, c]
                    own = np.where(homes == c, number[at] % parts, -1)
                    close = _to(lifted, centers[c]) - cells.radius[w, c] <= reach
                    for part in range(parts):
                        takes = own == part if home else close & (own != part)
                        rows.append(at[takes])
                        shards += [f"{w}:{c}:{part}"] * int(takes.sum())
            taken = batch.take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.string()), *taken.columns], names=["shard", *batch.schema.names])

    return asked.select("number", "query_id", "width", "q", "floor").mapInArrow(send, _SENT)


_SENT = "shard string, number bigint, query_id bigint, width int, q array<double>, floor bigint"
_FOUND = "number bigint, query_id bigint, vec_id bigint, score bigint"


def _searched(nodes: DataFrame, sent: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): every shard's pages once in one task, and the queries sent to it in passing."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, pages, tree = None, [], None
        for batch in batches:
            names = batch.column(0)
            at = 0
            for run in pc.run_end_encode(names).run_ends.to_pylist() if len(batch) else []:
                part, at = batch.slice(at, run - at), run
                if part.column(0)[0].as_py() != shard:
                    shard, pages, tree = part.column(0)[0].as_py(), [], None
                first = part.column("number").null_count
                if first:
                    pages.append(part.slice(0, first))
                for begin in range(first, len(part) if pages else 0, BLOCK_QUERIES):
                    block = part.slice(begin, BLOCK_QUERIES)
                    width = block.column("width")[0].as_py()
                    tree = tree or Tree(pa.Table.from_batches(pages).combine_chunks(), width)
                    ids, numbers = block.column("query_id").to_numpy(), block.column("number").to_numpy()
                    rows, found, scores = tree.search(ids, _matrix(block.column("q"), width), block.column("floor").to_numpy(), k)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(numbers[rows]), pa.array(ids[rows]), pa.array(found), pa.array(scores)],
                        names=["number", "query_id", "vec_id", "score"],
                    )

    none = lambda df, other: [F.lit(None).cast(f.dataType).alias(f.name) for f in other.schema.fields if f.name not in df.columns]
    pages, asked = nodes.select("*", *none(nodes, sent)), sent.select("*", *none(sent, nodes))
    dealt = pages.unionByName(asked).repartition("shard").sortWithinPartitions("shard", F.col("number").asc_nulls_first())
    return dealt.mapInArrow(search, _FOUND)


def top_k(points: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` largest inner products of each query, exact.

    Both tables are (vec_id, width, q) and written; rows with a query's own vec_id are no candidates, and
    only vectors of its width are. A query is searched in its home shard first, and the k-th score found there is the
    floor in the others; cells that cannot reach it are not asked. A shard's pages are sent to one task once, and
    its queries pass by in blocks. Every row counts: a vector that repeats takes as many ranks, and an id with several
    query rows has the best of all of them. Ties go to the smaller vec_id. Without other vectors a query has no
    rows, nor does an empty table. Scores are whole numbers, exact to 63 bits; larger ones are an error.
    """
    nodes, cells = build_index(points, k)
    asked = written(
        queries.select(F.monotonically_increasing_id().alias("number"), F.col("vec_id").alias("query_id"), "width", "q"), "mtree-queries"
    )
    none = F.lit(-(2**62)).cast("bigint")
    near = written(_searched(nodes, _sent(asked.withColumn("floor", none), cells, True), k), "mtree-home")
    kth = Window.partitionBy("number").orderBy(F.col("score").desc(), "vec_id")
    floors = near.withColumn("_r", F.row_number().over(kth)).filter(F.col("_r") == k).select("number", F.col("score").alias("floor"))
    after = asked.join(floors, "number", "left").withColumn("floor", F.coalesce("floor", none))
    far = _searched(nodes, _sent(after, cells, False), k)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        near.unionByName(far).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def nearest(vectors: DataFrame, every: int, k: int = 5) -> DataFrame:
    """Top ``k`` for the rows whose vec_id is divisible by ``every``, against all others.

    A vector that is null, empty or holds a null or non-finite component takes no part; nor
    does a null vec_id. Of an id that repeats with different vectors, each is a query and the
    best of them count. The cases of :func:`top_k` hold.
    """
    points = written(usable(vectors), "mtree-vectors")
    return top_k(points, points.filter(F.col("vec_id") % every == 0), k)
