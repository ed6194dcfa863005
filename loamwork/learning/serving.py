"""Top lists by exact search for the largest inner products, without scoring all pairs.

The factors that are searched are ordered by falling norm and cut into blocks. No product of a block is above the asked
factor's norm times the block's largest norm. So the blocks are taken in order, the best ``n`` so far are kept for each asked
id, and an id is done as soon as the bound of the next block is below its last place. What is left out can't enter.

Blocks go to the tasks in pieces of a fixed number, so nothing that is sent grows with the model; ids that are still open after a
piece go on to the next one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from loamwork.operators.positions import number_rows
from loamwork.workspace import cut_lineage

#: Rows of a block, and blocks that are sent at once: 131,072 factors.
BLOCK_ROWS, PIECE = 1024, 128
#: Asked ids of a task, and factors that one of them is multiplied with in a task of :func:`all_products`.
ASKED_ROWS, MET_ROWS = 4096, 262_144
#: Asked ids that are multiplied at a time, so that their products with 4,096 factors stay small, and factors that are compared by their largest product.
SLICE_ROWS, GROUP_ROWS = 512, 64
_STATE = "id int, features array<float>, found array<int>, scores array<double>, visited int, open boolean"


def norm_blocks(factors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(block, norm, ids, values) of factors (id, features): blocks of falling norm, ties by id; ``norm`` is the block's largest."""
    norm = F.sqrt(F.aggregate("features", F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    numbered = number_rows(factors.select((-norm).alias("_order"), "id", "features"), ["_order", "id"], "_at")
    rows = F.sort_array(F.collect_list(F.struct("_at", "id", "features", "_order")))
    return cut_lineage(numbered.groupBy(F.expr(f"_at div {block_rows}").cast("int").alias("block")).agg(rows.alias("rows"))).select(
        "block", (-F.col("rows._order")[0]).alias("norm"), F.col("rows.id").alias("ids"), F.flatten("rows.features").alias("values")
    )


def merged(row: np.ndarray, ids: np.ndarray, scores: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The best ``n`` (row, id, score) of each row, best first; equal scores go by id."""
    order = np.lexsort((ids, -scores, row))
    row, ids, scores = row[order], ids[order], scores[order]
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, int)
    place = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    kept = place < n
    return row[kept], ids[kept], scores[kept]


def search(asked: np.ndarray, blocks: list[tuple[float, np.ndarray, np.ndarray]], n: int, start: tuple, last: bool):
    """(row, id, score), blocks visited and whether each asked factor is still open, from a start of (row, id, score)."""
    row, ids, scores = start
    norms = np.linalg.norm(asked, axis=1)
    visited = np.zeros(len(asked), np.int32)

    def floor():
        out = np.full(len(asked), -np.inf)
        counts = np.bincount(row, minlength=len(asked))
        ends = np.cumsum(counts) - 1
        full = counts >= n
        out[full] = scores[ends[full]]
        return out

    worst, bounds = floor(), np.zeros(len(asked))
    for norm, block_ids, values in blocks:
        # A hair above the bound, for rounding; an equal score may still win by its id.
        bounds = norms * norm * (1 + 1e-12) + 1e-300
        live = np.flatnonzero(bounds >= worst)
        if not len(live):
            break
        visited[live] += 1
        product = asked[live] @ values.T
        at, column = np.nonzero(product >= worst[live][:, None])
        if not len(at):
            continue
        row, ids, scores = merged(np.append(row, live[at]), np.append(ids, block_ids[column]), np.append(scores, product[at, column]), n)
        worst = floor()
    return (row, ids, scores), visited, (bounds >= worst) & (not last)


def top_lists(asked: DataFrame, factors: DataFrame, n: int, block_rows: int = BLOCK_ROWS, piece: int = PIECE) -> DataFrame:
    """(id, place, other, score, visited): the ``n`` factors with the largest products for each asked (id, features).

    ``visited`` is the number of blocks that were scored for the id. Places start at 1; scores are doubles.
    """
    return search_blocks(asked, norm_blocks(factors, block_rows), n, piece)


def search_blocks(asked: DataFrame, blocks: DataFrame, n: int, piece: int = PIECE) -> DataFrame:
    """The lists of :func:`top_lists` from blocks that were cut before, such as stored ones: only those in reach are read."""
    spark = asked.sparkSession
    # However few bytes the asked factors are, each may meet many blocks: tasks get a fixed number of them.
    asked = cut_lineage(asked)
    asked = asked.repartition(max(1, -(-asked.count() // ASKED_ROWS)), "id")
    n_blocks = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    nothing = F.array()
    state = asked.select(
        F.col("id").cast("int").alias("id"), F.col("features").cast("array<float>").alias("features"), nothing.cast("array<int>").alias("found"),
        nothing.cast("array<double>").alias("scores"), F.lit(0).alias("visited"), F.lit(True).alias("open"),
    )
    done = state.where("false")
    for first in range(0, n_blocks, piece):
        rows = blocks.where((F.col("block") >= first) & (F.col("block") < first + piece)).collect()
        parts = [(r["norm"], np.array(r["ids"], np.int32), np.array(r["values"], np.float64).reshape(len(r["ids"]), -1)) for r in sorted(rows, key=lambda r: r["block"])]
        sent, last = spark.sparkContext.broadcast(parts), first + piece >= n_blocks

        def step(batches: Iterator[pa.RecordBatch], sent=sent, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    vectors = np.array(part.column("features").to_pylist(), np.float64)
                    lists = part.column("found").to_pylist()
                    start = (
                        np.repeat(np.arange(len(lists)), [len(x) for x in lists]), np.array([i for x in lists for i in x], np.int64),
                        np.array([s for x in part.column("scores").to_pylist() for s in x], np.float64),
                    )
                    (row, ids, scores), visited, still_open = search(vectors, sent.value, n, start, last)
                    offsets = np.append(0, np.cumsum(np.bincount(row, minlength=len(lists)))).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([
                        part.column("id"), part.column("features"), pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(scores)),
                        pa.array(visited + part.column("visited").to_numpy()), pa.array(still_open),
                    ], names=["id", "features", "found", "scores", "visited", "open"])

        after = cut_lineage(state.mapInArrow(step, _STATE))
        done = done.unionByName(after.where("NOT open"))
        state = after.where("open")
        if last or state.isEmpty():
            break
    pairs = F.posexplode(F.arrays_zip("found", "scores")).alias("_at", "_p")
    return done.select("id", "visited", pairs).select(
        "id", (F.col("_at") + 1).alias("place"), F.col("_p.found").alias("other"), F.col("_p.scores").alias("score"), "visited"
    )


def reached(asked: np.ndarray, others: np.ndarray, worst: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of all products that may be at least ``worst`` of their row and, with ``n``, among the row's ``n`` largest.

    All products are taken as floats, whose error has a bound; only pairs beyond reach of it are left out.
    """
    norms, largest = np.linalg.norm(asked.astype(np.float64), axis=1), np.linalg.norm(others.astype(np.float64), axis=1).max()
    kind = np.finfo(np.float32 if norms.max() * largest < 1e30 else np.float64)
    error = (asked.shape[1] + 2) * (kind.eps * norms * largest + kind.tiny)
    # Columns in groups, whose largest product of a row tells whether to look at them one by one; the last group is filled up.
    filled = np.zeros((-(-len(others) // GROUP_ROWS) * GROUP_ROWS, others.shape[1]), kind.dtype)
    filled[:len(others)] = others
    about = filled @ asked.astype(kind.dtype).T
    if 0 < n < len(others):
        worst = np.maximum(worst, np.partition(about[:len(others)].T, len(others) - n, axis=1)[:, len(others) - n] - error)
    least = worst - error
    groups = about.reshape(-1, GROUP_ROWS, len(asked))
    group, row = np.nonzero(groups.max(axis=1) >= least)
    at, within = np.nonzero(groups[group, :, row] >= least[row, None])
    row, column = row[at], group[at] * GROUP_ROWS + within
    return row[column < len(others)], column[column < len(others)]


def all_products(asked: DataFrame, factors: DataFrame, n: int) -> DataFrame:
    """(id, place, other, score): the lists of :func:`top_lists` from the products of all pairs, the yardstick of the search.

    Blocks of asked factors meet blocks of factors in a Cartesian product whose tasks have a bounded number of products each. A task
    keeps the best ``n`` of an asked block; what the tasks kept is merged per id. Scores are floats' products summed as doubles.
    """
    def blocks(frame: DataFrame, rows: int, name: str) -> DataFrame:
        parts = max(1, -(-frame.count() // rows))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    part = batch.slice(at, 4096)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([f"{part.column('id')[0]}"]), pa.array([part.column("id").to_pylist()], pa.list_(pa.int32())),
                        pa.array([[x for v in part.column("features").to_pylist() for x in v]], pa.list_(pa.float32())),
                    ], names=[f"{name}_block", f"{name}_ids", f"{name}_values"])

        dealt = frame.select(F.col("id").cast("int").alias("id"), F.col("features").cast("array<float>").alias("features")).repartition(parts, "id")
        # Checkpointed partitions are not merged, so the product has one task per pair of them.
        return cut_lineage(dealt.mapInArrow(pack, f"{name}_block string, {name}_ids array<int>, {name}_values array<float>"))

    def settled(lists: list[tuple], n_rows: int) -> tuple[list[tuple], np.ndarray]:
        row, found, scores = merged(*map(np.concatenate, zip(*lists)), n)
        floor, counts = np.full(n_rows, -np.inf), np.bincount(row, minlength=n_rows)
        floor[counts >= n] = scores[np.cumsum(counts)[counts >= n] - 1]
        return [(row, found, scores)], floor

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of each slice of an asked block, its ids, the best so far with what was met since, and the score below which nothing enters.
        best: dict[tuple, list] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                own, ids, values, other_ids, others = (batch.column(c)[i] for c in ("own_block", "own_ids", "own_values", "other_ids", "other_values"))
                own, ids, other_ids = own.as_py(), ids.values.to_numpy(), other_ids.values.to_numpy()
                values, others = (x.values.to_numpy().reshape(len(k), -1) for x, k in ((values, ids), (others, other_ids)))
                for at in range(0, len(ids), SLICE_ROWS):
                    part, fresh = values[at:at + SLICE_ROWS], (own, at) not in best
                    if fresh:
                        best[own, at] = [ids[at:at + SLICE_ROWS].copy(), [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))], np.full(len(part), -np.inf)]
                    kept = best[own, at]
                    row, column = reached(part, others, kept[2], n if fresh else 0)
                    if len(row):
                        kept[1].append((row, other_ids[column], np.einsum("ij,ij->i", part[row].astype(np.float64), others[column].astype(np.float64))))
                    # Lists are sorted once as many have been met as they hold.
                    if sum(len(x[0]) for x in kept[1][1:]) >= len(part) * n:
                        kept[1], kept[2] = settled(kept[1], len(part))
        for ids, lists, floor in best.values():
            [(row, found, scores)], _ = settled(lists, len(floor))
            yield pa.RecordBatch.from_arrays([pa.array(ids[row], pa.int32()), pa.array(found, pa.int32()), pa.array(scores)], names=["id", "other", "score"])

    pairs = blocks(asked, ASKED_ROWS, "own").crossJoin(blocks(factors, MET_ROWS, "other").hint("shuffle_replicate_nl"))
    kept = pairs.mapInArrow(meet, "id int, other int, score double")
    lists = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("_order"), "other", "score")))
    return kept.groupBy("id").agg(F.slice(lists, 1, n).alias("_l")).select("id", F.posexplode("_l").alias("_at", "_r")).select(
        "id", (F.col("_at") + 1).alias("place"), F.col("_r.other").alias("other"), F.col("_r.score").alias("score")
    )
