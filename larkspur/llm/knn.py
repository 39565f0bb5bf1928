"""Exact top-k search by a Voronoi kNN join.

Inner products become distances: with a last component sqrt(M^2 - |v|^2) for
data and 0 for queries, nearer is the same as a larger product. A few pivots cut
space into cells. Queries and data are grouped by nearest pivot; each cell's
count, radius and distances of its nearest members are its summary. From the
summaries every query group gets a distance within which k answers must lie, and
a data row goes only to the groups it can matter to. Rows travel in packed
blocks that are salted over tasks; every block gives at most k rows a query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from larkspur.session import cut_lineage

K = 20
SCALE = 64.0
PIVOTS = 16
PIVOT_SAMPLE = 2000
BLOCK = 2048
SALTS = 32

_BLOCKS = "cell int, salt int, ids binary, rows binary, vectors binary"


def scaled(column, scale: float = SCALE):
    """floor(scale * x) of every component as an array of longs; null if the vector takes no part."""
    parts = F.transform(column, lambda x: x.cast("double"))
    fit = column.isNotNull() & F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fit, F.transform(parts, lambda x: F.floor(x * F.lit(scale)).cast("long")))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of equal length; a shorter vector is filled up with zeros."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


class _Space:
    """Pivots and the distance to them in the space with the extra component."""

    def __init__(self, pivots: np.ndarray, largest: float):
        self.pivots, self.largest = pivots, largest

    def lifted(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        plain = vectors.astype(float)
        extra = np.zeros(len(plain)) if query else np.sqrt(np.maximum(self.largest - (plain ** 2).sum(1), 0))
        return np.column_stack((plain, extra))

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points ** 2).sum(1)[:, None] + (self.pivots ** 2).sum(1)[None, :] - 2 * points @ self.pivots.T
        return np.sqrt(np.maximum(square, 0))


def _of_each_id(away: np.ndarray, ids: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The nearest distance of each of the ``count`` nearest ids."""
    order = np.argsort(away, kind="stable")
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:count]
    return away[order][first], ids[order][first]


def _products(queries: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Exact integer products; through floating point where every sum fits its 53 bits."""
    reach = float(np.abs(queries).max(initial=0)) * float(np.abs(data).max(initial=0)) * max(queries.shape[1], 1)
    if reach < 2 ** 53:
        return (queries.astype(float) @ data.T.astype(float)).astype(np.int64)
    return queries @ data.T


def _packed(rows, width: int):
    """Scan of (cell, salt, id, row, vector) lists as blocks of one cell and salt."""
    out = {"cell": [], "salt": [], "ids": [], "rows": [], "vectors": []}
    for cell, salt, *lists in rows:
        for name, value in zip(out, (cell, salt, *[x.astype(np.int64).tobytes() for x in lists])):
            out[name].append(value)
    return pa.RecordBatch.from_arrays(
        [pa.array(out["cell"], pa.int32()), pa.array(out["salt"], pa.int32()), *[pa.array(out[n], pa.binary()) for n in ("ids", "rows", "vectors")]],
        names=list(out))


def top_k(vectors: DataFrame, queries, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          pivots: int = PIVOTS) -> DataFrame:
    """(query, rank, id, score): the ``k`` largest integer products of each query row with all other rows.

    ``queries`` is a condition on the rows that are queries. Ties go to the
    smaller id. A query never meets rows of its own id; repeated rows count as
    often as they occur, and each of several query rows of one id has a
    ranking of its own. Rows with a null id, or a vector that is
    null or holds null or non-finite components, take no part; vectors of other
    lengths count as filled up with zeros. Sums must fit 64 bits.

    Pivots are drawn from ``PIVOT_SAMPLE`` rows at most; what the driver and
    every task hold is ``pivots`` x (k + width) numbers.
    """
    rows = cut_lineage(vectors.withColumn("_vector", scaled(F.col(vector_col))).where(
        F.col("_vector").isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.coalesce(queries, F.lit(False)).alias("query"), F.col("_vector").alias("vector"))) \
        .withColumn("row", F.monotonically_increasing_id())
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    facts = rows.agg(F.max(F.size("vector")), F.max(square), F.count("*")).first()
    schema = "query long, rank int, id long, score long"
    if not facts[2]:
        return rows.sparkSession.createDataFrame([], schema)
    width, largest = facts[0], facts[1]
    drawn = rows.orderBy(F.xxhash64("id", "vector")).limit(min(PIVOT_SAMPLE, pivots)).select("vector").collect()
    seeds = np.unique(np.array([list(r[0]) + [0] * (width - len(r[0])) for r in drawn], np.int64).reshape(len(drawn), width), axis=0)
    space = _Space(np.zeros((0, width + 1)), largest)
    space.pivots = space.lifted(seeds, False)
    count = len(space.pivots)

    def summarised(batches):
        radius = np.zeros((2, count))
        nearest = [(np.zeros(0), np.zeros(0, np.int64)) for _ in range(count)]
        for batch in batches:
            found = _matrix(batch.column(1), width)
            is_query, ids = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy()
            for side, points in ((0, space.lifted(found, False)), (1, space.lifted(found[is_query], True))):
                if len(points):
                    away = space.distances(points)
                    cell = away.argmin(1)
                    own = away[np.arange(len(away)), cell]
                    np.maximum.at(radius[side], cell, own)
                    if side == 0:
                        for c in np.unique(cell):
                            nearest[c] = _of_each_id(*(np.concatenate(x) for x in zip(nearest[c], (own[cell == c], ids[cell == c]))), k + 1)
        yield pa.RecordBatch.from_arrays([
            pa.array(range(count), pa.int32()), pa.array(radius[0]), pa.array(radius[1]),
            pa.array([away.tolist() for away, _ in nearest], pa.list_(pa.float64())),
            pa.array([ids.tolist() for _, ids in nearest], pa.list_(pa.int64()))], names=["cell", "radius", "reach", "nearest", "whose"])

    def merged(key, table):
        away, whose = (np.array([x for part in table[name].to_pylist() for x in part]) for name in ("nearest", "whose"))
        away, whose = _of_each_id(away.astype(float), whose.astype(np.int64), k + 1)
        top = [max(table[name].to_pylist()) for name in ("radius", "reach")]
        return pa.table({"cell": pa.array([key[0].as_py()], pa.int32()), "radius": [top[0]], "reach": [top[1]],
                         "nearest": pa.array([away.tolist()], pa.list_(pa.float64())), "whose": pa.array([whose.tolist()], pa.list_(pa.int64()))})

    kinds = "cell int, radius double, reach double, nearest array<double>, whose array<long>"
    summary = rows.select("query", "vector", "id").mapInArrow(summarised, kinds).groupBy("cell").applyInArrow(merged, kinds).orderBy("cell").collect()
    between = space.distances(space.pivots)
    # rows of a query's own id may be among the nearest, hence the nearest of k + 1 ids
    radius, bound = np.zeros(count), np.full(count, np.inf)
    reach = np.zeros(count)
    for row in summary:
        radius[row["cell"]], reach[row["cell"]] = row["radius"], row["reach"]
    for cell in range(count):
        within, _ = _of_each_id(np.concatenate([reach[cell] + between[cell, row["cell"]] + np.array(row["nearest"]) for row in summary]),
                                np.concatenate([np.array(row["whose"], np.int64) for row in summary]), k + 1)
        if len(within) > k:
            bound[cell] = within[k]
    slack = 1e-6 * (1 + np.sqrt(largest))

    def replicated(batches):
        for block, batch in enumerate(batches):
            ids, found = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            out = []
            if len(ids):
                away = space.distances(space.lifted(found, False))
                own = away.min(1)
                for cell in range(count):
                    # away from the group's pivot by more than its reach and bound: no query there can want the row
                    wanted = np.flatnonzero((away[:, cell] - reach[cell] <= bound[cell] + slack) & (own >= 0))
                    for low in range(0, len(wanted), BLOCK):
                        part = wanted[low:low + BLOCK]
                        out.append((cell, int(ids[part[0]] % SALTS), ids[part], ids[:0], found[part]))
            yield _packed(out, width)

    def grouped(batches):
        for batch in batches:
            ids, found, numbers = batch.column(0).to_numpy(), _matrix(batch.column(1), width), batch.column(2).to_numpy()
            out = []
            if len(ids):
                cells = space.distances(space.lifted(found, True)).argmin(1)
                for cell in np.unique(cells):
                    own = np.flatnonzero(cells == cell)
                    for low in range(0, len(own), BLOCK):
                        part = own[low:low + BLOCK]
                        out += [(int(cell), salt, ids[part], numbers[part], found[part]) for salt in range(SALTS)]
            yield _packed(out, width)

    def solved(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                qid, number, q, did, d = (np.frombuffer(batch.column(i)[at].as_buffer(), np.int64) for i in range(5))
                products = _products(q.reshape(len(qid), width), d.reshape(len(did), width))
                owner, row, ids, scores = [], [], [], []
                by_id = np.argsort(did, kind="stable")
                did = did[by_id]
                for i, mine in enumerate(products[:, by_id]):
                    other = np.flatnonzero(did != qid[i])
                    best = other[np.argsort(-mine[other], kind="stable")[:k]]
                    owner.append(np.full(len(best), qid[i]))
                    row.append(np.full(len(best), number[i]))
                    ids.append(did[best])
                    scores.append(mine[best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), pa.int64()) for x in (owner, row, ids, scores)], names=["query", "row", "id", "score"])

    left = rows.where("query").select("id", "vector", "row").mapInArrow(grouped, _BLOCKS) \
        .select("cell", "salt", F.col("ids").alias("q_ids"), F.col("rows").alias("q_rows"), F.col("vectors").alias("q_vectors"))
    right = rows.select("id", "vector").mapInArrow(replicated, _BLOCKS)
    met = left.join(right.hint("shuffle_hash"), ["cell", "salt"]).select("q_ids", "q_rows", "q_vectors", "ids", "vectors")
    local = met.mapInArrow(solved, "query long, row long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.desc("score"), "id"))
    return local.withColumn("rank", rank).where(F.col("rank") <= k).select("query", "rank", "id", "score")
