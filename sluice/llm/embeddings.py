"""Near-duplicates of embeddings over an inverted multi-index."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, local_components, run_starts, sorted_runs
from .components import connected_components

#: Vectors that the codebooks are fitted on, at most.
SAMPLE = 40_000
#: Vectors of a cell, about, and centroids of a half at most: a grid of this size has some 400 vectors a cell up to 1.6 thousand million vectors. Beyond
#: that cells grow, and are dealt in blocks as crowded ones are.
CELL, MOST_CENTRES = 400, 2048
#: Members, and queries, of a cell that one task compares at once; crowded cells are so many blocks.
MEMBERS, QUERIES = 2_000, 8_000
TARGET_RECALL = 0.97


def codebook(points: np.ndarray, k: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """k-means on some 20 points a centroid or all; a centroid without points stays where it is."""
    rng = np.random.default_rng(seed)
    unique = np.unique(points, axis=0)
    centres = unique[rng.permutation(len(unique))[:k]].copy()
    points = points[: max(10_000, 20 * k)]
    for _ in range(rounds):
        own = np.concatenate([nearest(points[lo : lo + 4096], centres).argmin(1) for lo in range(0, len(points), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, rows x centres."""
    return np.maximum((x**2).sum(1)[:, None] + (centres**2).sum(1) - 2 * x @ centres.T, 0)


def traverse(x: np.ndarray, books: tuple[np.ndarray, np.ndarray], cells: int) -> np.ndarray:
    """For each vector the ``cells`` nearest cells of the product grid, nearest first.

    The order is that of the multi-sequence algorithm, which takes pairs of ranks by the sum of their distances. A cell at ranks
    (i, j) has (i + 1)(j + 1) - 1 cells before it, so only ranks with (i + 1)(j + 1) <= cells are ever reached: those pairs are
    summed and sorted for all vectors at once.
    """
    half = x.shape[1] // 2
    a, b = nearest(x[:, :half], books[0]), nearest(x[:, half:], books[1])
    ra, rb = np.argsort(a, axis=1, kind="stable"), np.argsort(b, axis=1, kind="stable")
    reach = [min(cells // (k + 1), len(books[1])) for k in range(min(cells, len(books[0])))]
    i, j = np.repeat(np.arange(len(reach)), reach), np.concatenate([np.arange(n) for n in reach])
    sums = np.take_along_axis(a, ra[:, i], 1) + np.take_along_axis(b, rb[:, j], 1)
    order = np.argsort(sums, axis=1, kind="stable")[:, :cells]
    return (np.take_along_axis(ra, i[order], 1) * len(books[1]) + np.take_along_axis(rb, j[order], 1)).astype(np.int32)


def cells_needed(points: np.ndarray, books, cosine: float, recall: float, seed: int = 5) -> int:
    """How many cells a traversal visits until ``recall`` of partners at just ``cosine``, in any direction, have been met from either side."""
    rng = np.random.default_rng(seed)
    x = points[rng.permutation(len(points))[:2000]]
    off = rng.standard_normal(x.shape)
    off -= (off * x).sum(1, keepdims=True) * x
    off /= np.maximum(np.linalg.norm(off, axis=1, keepdims=True), 1e-12)
    y = cosine * x + np.sqrt(1 - cosine**2) * off
    own_x, own_y = traverse(x, books, 1)[:, 0], traverse(y, books, 1)[:, 0]
    rank = np.minimum(ranks(x, own_y, books), ranks(y, own_x, books))
    return int(np.quantile(rank, recall, method="higher")) + 1


def ranks(x: np.ndarray, cell: np.ndarray, books) -> np.ndarray:
    """How many cells a traversal from each vector visits before the given one: those whose distances sum to less."""
    half = x.shape[1] // 2
    i, j = np.divmod(cell.astype(np.int64), len(books[1]))
    out = np.zeros(len(x), np.int64)
    for k in range(len(x)):
        a, b = nearest(x[k : k + 1, :half], books[0])[0], np.sort(nearest(x[k : k + 1, half:], books[1])[0])
        own = nearest(x[k : k + 1, half:], books[1])[0][j[k]]
        out[k] = np.searchsorted(b, a[i[k]] + own - a, side="left").sum()
        out[k] -= np.searchsorted(b, own) > np.searchsorted(b, a[i[k]] + own - a[i[k]])  # its own sum, as rounded
    return np.maximum(out, 0)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def units_of(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_batches(width: int, single: bool):
    """(id, embedding) to the vectors that can be compared, as they are, in single precision where the table has that."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column(0).to_numpy(), [v if v is not None and len(v) == width and None not in v else None for v in batch.column(1).to_pylist()]
            good = [k for k, v in enumerate(rows) if v is not None]
            x = np.array([rows[k] for k in good], np.float64).reshape(-1, width)
            size = np.linalg.norm(x, axis=1)
            fine = np.isfinite(x).all(1) & np.isfinite(size) & (size > 0)
            keep = np.array(good, np.int64)[fine]
            flat = x[fine].astype(np.float32 if single else np.float64).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(ids[keep]), pa.ListArray.from_arrays(pa.array(np.arange(len(keep) + 1, dtype=np.int32) * width), pa.array(flat))], ["id", "v"])

    return run


def deal_batches(books, cells: int, width: int, blocks: dict[int, tuple[int, int]]):
    """Each vector once as a member of its cell, with the cells it visits, and once per visited cell as a query.

    A crowded cell is dealt as blocks: a member goes to each query block, a query to each member block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most_q = max([q for _, q in blocks.values()], default=1)
        most_m = max([m for m, _ in blocks.values()], default=1)
        crowded = np.array(sorted(blocks), np.int64)
        parts = np.array([blocks[c] for c in sorted(blocks)] + [(1, 1)], np.int64)

        def shape(cells: np.ndarray) -> np.ndarray:
            """Member blocks and query blocks of each cell."""
            at = np.searchsorted(crowded, cells)
            return parts[np.where(np.append(crowded, -1)[at] == cells, at, len(crowded))]

        stride = most_m * most_q
        for batch in batches:
            ids, x = batch.column(0).to_numpy(), matrix(batch.column(1), width)
            for lo in range(0, len(ids), 1000):
                part, v = ids[lo : lo + 1000], x[lo : lo + 1000]
                visits = traverse(units_of(v), books, cells)
                own, draw = visits[:, 0].astype(np.int64), (part.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
                row, role, key = [], [], []
                of_own = shape(own)
                for q in range(most_q):
                    has = np.flatnonzero(q < of_own[:, 1])
                    row.append(has)
                    role.append(np.zeros(len(has), bool))
                    key.append(own[has] * stride + (draw[has] % of_own[has, 0]) * most_q + q)
                flat = visits.astype(np.int64).ravel()
                who, of_flat = np.repeat(np.arange(len(part)), visits.shape[1]), shape(flat)
                for m in range(most_m):
                    has = np.flatnonzero(m < of_flat[:, 0])
                    row.append(who[has])
                    role.append(np.ones(len(has), bool))
                    key.append(flat[has] * stride + m * most_q + (draw[who[has]] // 7919) % of_flat[has, 1])
                row, role, key = map(np.concatenate, (row, role, key))
                size = visits.shape[1]
                member_visits = np.where(role, 0, 1) * size
                cut = np.concatenate(([0], np.cumsum(member_visits))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key),
                        pa.array(part[row]),
                        pa.array(role),
                        pa.array(own[row].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(cut), pa.array(visits[row[~role]].ravel())),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(row) + 1, dtype=np.int32) * width), pa.array(v[row].ravel())),
                    ],
                    ["key", "id", "query", "cell", "visits", "v"],
                )

    return run


def verify_batches(cosine: float, width: int, cells: int, stride: int):
    """Compares the queries and members of each block in double precision; gives links per vector and edges that join what links join.

    A pair that both sides visit is met twice, once from each, and counts for the query each time; a pair that only one side visits counts
    for both. Edges are a forest: fewer than vectors, whatever the number of pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_runs(batches, "key", 1 << 14):
            keys = part.column("key").to_numpy()
            out_id, out_n, a, b = [], [], [], []
            starts = run_starts(keys)
            for lo, hi in zip(starts[:-1], starts[1:], strict=True):
                block = part.slice(lo, hi - lo)
                role, ids = block.column("query").to_numpy(), block.column("id").to_numpy()
                if role.all() or not role.any():
                    continue
                x, own = units_of(matrix(block.column("v"), width)), block.column("cell").to_numpy()
                here = int(keys[lo]) // stride
                q, m = np.flatnonzero(role), np.flatnonzero(~role)
                visits = block.column("visits").combine_chunks().flatten().to_numpy().reshape(len(m), -1)
                links = np.zeros(len(ids), np.int64)
                for at in range(0, len(q), 2000):
                    some = q[at : at + 2000]
                    near = (x[some] @ x[m].T) >= cosine
                    near &= ids[some][:, None] != ids[m]
                    i, j = np.nonzero(near)
                    if not len(i):
                        continue
                    links[some] += near.sum(1)
                    one_sided = own[some][i] != here
                    if one_sided.any():
                        k = np.flatnonzero(one_sided)
                        k = k[~(visits[j[k]] == own[some][i[k]][:, None]).any(1)]
                        np.add.at(links, m[j[k]], 1)
                    nodes, index = np.unique(np.concatenate((ids[some][i], ids[m][j])), return_inverse=True)
                    root = local_components(index[: len(i)], index[len(i) :], len(nodes))
                    apart = root != np.arange(len(nodes))
                    a.append(nodes[apart])
                    b.append(nodes[root[apart]])
                has = links > 0
                out_id.append(ids[has])
                out_n.append(links[has])
            ids, n = np.concatenate([*out_id, np.zeros(0, np.int64)]), np.concatenate([*out_n, np.zeros(0, np.int64)])
            a, b = np.concatenate([*a, np.zeros(0, np.int64)]), np.concatenate([*b, np.zeros(0, np.int64)])
            none = lambda k: pa.nulls(k, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.concat_arrays([pa.array(ids), none(len(a))]), pa.concat_arrays([pa.array(n), none(len(a))]), pa.concat_arrays([none(len(ids)), pa.array(a)]), pa.concat_arrays([none(len(ids)), pa.array(b)])], ["id", "n", "a", "b"])

    return run


def links_of(named: DataFrame, width: int, ws: Workspace, cosine: float, recall: float, sample: int) -> DataFrame:
    """(id, n, a, b): links per vector, and edges that join what links join, among the vectors of one length; ``named`` has one row per id."""
    drawn = named.orderBy(F.xxhash64("id"), "id").limit(sample).collect()
    points = units_of(np.array([r["v"] for r in drawn], np.float64).reshape(-1, width))
    single = named.schema["v"].dataType.elementType.typeName() == "float"
    kind = "float" if single else "double"
    units = ws.save(named.mapInArrow(fit_batches(width, single), f"id long, v array<{kind}>"), f"units{width}")
    total = units.count()
    side = int(np.clip(round((total / CELL) ** 0.5), 1, MOST_CENTRES))
    half = width // 2
    books = (codebook(points[:, :half], side), codebook(points[:, half:], side))
    cells = cells_needed(points, books, cosine, recall)

    def cell_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grid = np.zeros((2, len(books[0]) * len(books[1])), np.int32)
        for batch in batches:
            x = matrix(batch.column(1), width)
            for lo in range(0, len(x), 1000):
                visits = traverse(units_of(x[lo : lo + 1000]), books, cells)
                grid[0] += np.bincount(visits[:, 0], minlength=grid.shape[1]).astype(np.int32)
                grid[1] += np.bincount(visits.ravel(), minlength=grid.shape[1]).astype(np.int32)
        used = np.flatnonzero(grid.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(grid[0, used].astype(np.int64)), pa.array(grid[1, used].astype(np.int64))], ["cell", "members", "queries"])

    # Only crowded cells come to the driver: at most as many as the grid has cells.
    sizes = units.mapInArrow(cell_batches, "cell long, members long, queries long").groupBy("cell").agg(F.sum("members").alias("m"), F.sum("queries").alias("q"))
    sizes = sizes.where((F.col("m") > MEMBERS) | (F.col("q") > QUERIES)).collect()
    blocks = {r["cell"]: (max(1, -(-r["m"] // MEMBERS)), max(1, -(-r["q"] // QUERIES))) for r in sizes}
    stride = max([m for m, _ in blocks.values()], default=1) * max([q for _, q in blocks.values()], default=1)
    dealt = units.mapInArrow(deal_batches(books, cells, width, blocks), f"key long, id long, query boolean, cell int, visits array<int>, v array<{kind}>")
    met = dealt.repartition("key").sortWithinPartitions("key").mapInArrow(verify_batches(cosine, width, cells, stride), "id long, n long, a long, b long")
    return ws.save(met, f"met{width}")


def embedding_dedup(vectors: DataFrame, ws: Workspace, cosine: float = 0.95, recall: float = TARGET_RECALL, sample: int = SAMPLE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of ``vectors``.

    The two halves of each unit vector have a codebook each, fitted on at most ``sample`` vectors drawn by a hash; the pairs of
    centroids are the grid's cells, about one per few hundred vectors. Every vector is a member of its nearest cell, and visits cells in multi-sequence
    order, as many as partners at just ``cosine`` need to be met with probability ``recall``. Every pair that meets is verified in double
    precision, so none below ``cosine`` is linked. Equal vectors under several ids always meet, having the same cell.

    Vectors of unlike lengths link with nothing of another length; each length has a grid of its own. Null vectors, zero vectors, and vectors with null
    or non-finite components link with nothing: 0 links, a component of their own. Rows that repeat an id are one vector, the least of them; null ids link
    with nothing. Extra columns are ignored; no rows give no rows.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    named = rows.where("id is not null and v is not null and size(v) > 0 and not exists(v, x -> x is null or isnan(x) or abs(x) = double('infinity')) and exists(v, x -> x <> 0)")
    named = ws.save(named.groupBy("id").agg(F.min("v").alias("v")), "named")
    widths = [r[0] for r in named.select(F.size("v").alias("n")).distinct().orderBy("n").toLocalIterator()]
    parts = [links_of(named.where(F.size("v") == n), n, ws, cosine, recall, sample) for n in widths]
    met = reduce(DataFrame.unionByName, parts) if parts else named.sparkSession.createDataFrame([], "id long, n long, a long, b long")
    links = met.where("id is not null").groupBy("id").agg(F.sum("n").alias("n_links"))
    found = connected_components(met.where("a is not null").select("a", "b"), ws)
    out = rows.select("id").join(links, "id", "left").join(found.withColumnRenamed("node", "id"), "id", "left")
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id")).withColumn("kept", F.col(id_col).eqNullSafe(F.col("component_id")))
