"""Approximate nearest neighbours by cosine: multiprobe p-stable hashing.

Method: vectors are scaled to length 1, where the nearest by cosine is the nearest by distance. Each of ``TABLES`` tables
projects them on Gaussian directions (2-stable), more of them the more rows there are, and cuts each projection into cells of ``WIDTH``; the cells'
numbers are the bucket. A query estimates for each of its projections how likely a near vector lies in each cell around its own, and visits
buckets of each table in order of that success probability, until all tables together succeed with ``SUCCESS`` or ``PROBES`` are
visited. How near its neighbours are is learned from a sample: the exact neighbours of ``SAMPLE`` queries among all rows.

Rows are stored once, in blocks of ``SPLIT`` along the buckets of the first table. A query goes to the blocks that hold a bucket it visits in any
table; there the candidates of all tables are merged, so each pair is computed once, many at a time as a product of matrices, and the
few best get their exact cosine in double precision. Queries are split as blocks are, so a task holds ``SPLIT`` rows and about ``TOGETHER`` queries.
What a query visits is joined to the buckets by shuffles, never by a broadcast, and goes to each block as the numbers of its buckets there.

Equal vectors are one candidate with its smallest ids, as no other of them can be among a query's nearest. No bucket is capped. Queries that found
fewer than ``k`` search all blocks.

Results for odd input: vectors that are NULL, zero or hold NULL or non-finite components take no part, nor do rows without
an id. Rows with equal id and vector are one row; equal ids with other vectors are candidates of their own, but never
of a query of that id. Vectors of different lengths never meet. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from signal_lake.llm.common import BATCH_ROWS, prepare
from signal_lake.operators.skew import global_rank
from signal_lake.session import stage

TABLES, WIDTH, PROBES = 4, 2.0, 160
SPLIT, TOGETHER = 4096, 1024
SEED = 20240601
#: Cosine between a query and the neighbours it should find where no sample tells; sets how the success of cells is estimated.
NEAR = 0.4
SUCCESS, SAMPLE = 0.97, 64
#: Rows a bucket has on average, and cells that a projection of unit vectors spreads over.
BUCKET, CELLS = 32, 2.3
_REACH = 3


@lru_cache(maxsize=16)
def directions(dimension: int, tables: int, projections: int) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions of all tables and the offsets of their cells."""
    rng = np.random.default_rng([SEED, dimension, tables, projections])
    return rng.standard_normal((dimension, tables * projections)), rng.uniform(0, WIDTH, tables * projections)


def projections_for(rows: int) -> int:
    """Projections of a table for so many rows."""
    return int(np.clip(round(np.log(max(rows, 1) / BUCKET) / np.log(CELLS)), 4, 24))


def _keys(cells: np.ndarray) -> np.ndarray:
    """One number per bucket, a hash of its cells, which are the last axis."""
    key = np.zeros(cells.shape[:-1], dtype=np.uint64)
    for k in range(cells.shape[-1]):
        key = (key + cells[..., k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def buckets(unit: np.ndarray, tables: int, projections: int) -> np.ndarray:
    """Bucket of each vector in each table."""
    lines, offsets = directions(unit.shape[1], tables, projections)
    cells = np.floor((unit @ lines + offsets) / WIDTH).astype(np.int64)
    return _keys(cells.reshape(len(unit), tables, projections))


def _normal(x: np.ndarray) -> np.ndarray:
    """Distribution function of the normal, by an approximation good to 1e-4."""
    z = np.abs(x)
    t = 1 / (1 + 0.2316419 * z)
    tail = np.exp(-z * z / 2) * 0.3989423 * t * (0.3193815 + t * (-0.3565638 + t * (1.781478 + t * (-1.821256 + t * 1.330274))))
    return np.where(x >= 0, 1 - tail, tail)


def probes(unit: np.ndarray, tables: int, projections: int, count: int, near: float = NEAR) -> np.ndarray:
    """The ``count`` buckets of each table that most likely hold a near vector, likeliest first: (query, table, probe)."""
    return likely_buckets(unit, tables, projections, count, near)[0]


def likely_buckets(unit: np.ndarray, tables: int, projections: int, count: int, near: float = NEAR) -> tuple[np.ndarray, np.ndarray]:
    """(buckets as ``probes`` gives them, the probability of each that it holds the near vector).

    A vector at cosine ``near`` projects to near * q + sqrt(1 - near ** 2) * g, where q is the query's projection and g is normal.
    Costs (minus the log of a cell's probability over the best cell's) add up over the projections, so the cheapest sums
    over all projections are among the cheapest over the first ones.
    """
    lines, offsets = directions(unit.shape[1], tables, projections)
    at = unit @ lines
    center = np.floor((near * at + offsets) / WIDTH).astype(np.int64)
    steps = np.arange(-_REACH, _REACH + 1)
    cells = center[..., None] + steps
    spread = np.sqrt(1 - near * near)
    low = (cells * WIDTH - offsets[None, :, None] - near * at[..., None]) / spread
    chance = np.maximum(_normal(low + WIDTH / spread) - _normal(low), 1e-12)
    cost = -np.log(chance)
    n = len(unit)
    cost, cells = cost.reshape(n * tables, projections, -1), cells.reshape(n * tables, projections, -1)
    total, picked = np.zeros((n * tables, 1)), np.zeros((n * tables, 1, 0), dtype=np.int64)
    for k in range(projections):
        sums = (total[:, :, None] + cost[:, k, None, :]).reshape(len(total), -1)
        keep = min(count, sums.shape[1])
        order = np.argpartition(sums, keep - 1, axis=1)[:, :keep]
        before, step = order // len(steps), order % len(steps)
        picked = np.concatenate([np.take_along_axis(picked, before[..., None], axis=1), np.take_along_axis(cells[:, k], step, axis=1)[..., None]], axis=2)
        total = np.take_along_axis(sums, order, axis=1)
    order = np.argsort(total, axis=1, kind="stable")
    keys = _keys(np.take_along_axis(picked, order[..., None], axis=1)).reshape(n, tables, -1)
    return keys, np.exp(-np.take_along_axis(total, order, axis=1)).reshape(n, tables, -1)


def wanted(chance: np.ndarray, tables: int, success: float = SUCCESS) -> np.ndarray:
    """Which probes are visited: those before the first at which the table's success is enough for all tables together."""
    enough = 1 - (1 - success) ** (1 / tables)
    return np.cumsum(chance, axis=-1) - chance < enough


def _vectors(column: pa.Array) -> np.ndarray:
    sizes = column.value_lengths().to_numpy()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(sizes), -1)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def _by_dimension(made: Callable[[int, np.ndarray], list[np.ndarray]], rows: DataFrame) -> DataFrame:
    """Rows (row, dimension, keys): a list of buckets for each table, all tables in one list, that ``made`` gives for vectors of one dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for dimension in np.unique(sizes):
                some = batch.take(pa.array(np.flatnonzero(sizes == dimension)))
                lists = made(int(dimension), _unit(_vectors(some.column(1))))
                yield pa.record_batch(
                    [some.column(0), pa.array(np.full(some.num_rows, dimension), pa.int32()), pa.array(lists, pa.list_(pa.list_(pa.int64())))], ["row", "dimension", "keys"]
                )

    return rows.select("row", "vector").mapInArrow(run, "row bigint, dimension int, keys array<array<bigint>>")


def typical_nearness(candidates: DataFrame, asked: DataFrame, k: int) -> dict[int, float]:
    """By dimension, the cosine that nine of ten queries of a sample have to their ``k``-th neighbour among all rows.

    ``SAMPLE`` queries, drawn by a hash, come to the driver and are sent to all tasks; each task gives its best for each of them.
    """
    sample = asked.orderBy(F.xxhash64("query_id", "row")).limit(SAMPLE).select("vector").collect()
    by_size: dict[int, np.ndarray] = {}
    for size in {len(r["vector"]) for r in sample}:
        by_size[size] = _unit(np.array([r["vector"] for r in sample if len(r["vector"]) == size]))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {size: np.zeros((len(queries), 0)) for size, queries in by_size.items()}
        for batch in batches:
            sizes = batch.column(0).value_lengths().to_numpy()
            for size in set(by_size) & set(sizes.tolist()):
                some = batch.column(0).take(pa.array(np.flatnonzero(sizes == size)))
                scores = np.concatenate([kept[size], by_size[size] @ _unit(_vectors(some)).T], axis=1)
                kept[size] = -np.sort(-scores, axis=1)[:, : k + 1]
        rows = [(size, q, float(s)) for size, scores in kept.items() for q, row in enumerate(scores) for s in row]
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.float64()), strict=True)], ["size", "q", "s"])

    found = candidates.select("vector").mapInArrow(best, "size int, q int, s double")
    # A query's own vector is one of the rows, so its k-th neighbour is one further.
    kth = found.groupBy("size", "q").agg(F.get(F.sort_array(F.collect_list("s"), asc=False), F.lit(k)).alias("s")).where("s IS NOT NULL").collect()
    return {size: float(np.clip(np.quantile([r["s"] for r in kth if r["size"] == size], 0.1), 0.2, 0.98)) for size in {r["size"] for r in kth}}


def cosines(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of each row with the query, each computed alike wherever the row stands.

    Powers of two bring the greatest component near 1 first, which changes no digit but keeps squares in range.
    """
    query = np.ldexp(query, -np.frexp(np.abs(query).max())[1])
    rows = np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])
    dots = (rows * query).sum(axis=1)
    return dots / (np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def merged_candidates(order: list[np.ndarray], keys: list[np.ndarray], visited: list[np.ndarray], mask: np.ndarray) -> np.ndarray:
    """Rows of a block that lie in a visited bucket of any table, each once; ``keys`` of each table are sorted by its ``order``, ``mask`` is all false."""
    for by, sorted_keys, asked in zip(order, keys, visited, strict=True):
        first, past = np.searchsorted(sorted_keys, asked, "left"), np.searchsorted(sorted_keys, asked, "right")
        sizes = past - first
        total = int(sizes.sum())
        if total:
            ends = np.cumsum(sizes)
            mask[by[np.repeat(first - (ends - sizes), sizes) + np.arange(total)]] = True
    found = np.flatnonzero(mask)
    mask[found] = False
    return found


def _dealt(visits: DataFrame, tables: int) -> DataFrame:
    """One row per query and block it visits, ``met`` being the numbers of the visited buckets there: a list for each table.

    ``visits`` are rows (query_id, dimension, vector, visits) with a list of (table, places), a place being the block times ``SPLIT`` plus the bucket's number.
    """
    split = SPLIT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            visited = batch.column(3).flatten()
            places = visited.field("places")
            asks = np.repeat(np.arange(batch.num_rows), batch.column(3).value_lengths().to_numpy())
            sizes = places.value_lengths().to_numpy()
            place = places.flatten().to_numpy()
            ask, table, block = np.repeat(asks, sizes), np.repeat(visited.field("table").to_numpy(), sizes), place // split
            order = np.argsort((ask * (block.max(initial=0) + 1) + block) * tables + table, kind="stable")
            ask, table, block, number = ask[order], table[order], block[order], (place[order] % split).astype(np.int32)
            starts = np.flatnonzero(np.diff(ask, prepend=-1) | np.diff(block, prepend=-1))
            ends = np.append(starts[1:], len(ask))
            for i in range(0, len(starts), BATCH_ROWS):
                some = starts[i : i + BATCH_ROWS]
                here = slice(some[0], ends[i : i + BATCH_ROWS][-1])
                row = np.repeat(np.arange(len(some)), ends[i : i + BATCH_ROWS] - some)
                offsets = np.append(0, np.cumsum(np.bincount(row * tables + table[here], minlength=len(some) * tables)))
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(number[here]))
                met = pa.ListArray.from_arrays(pa.array(np.arange(0, len(some) * tables + 1, tables), pa.int32()), lists)
                query_id, dimension, vector = (batch.column(c).take(pa.array(ask[some])) for c in range(3))
                yield pa.record_batch([query_id, dimension, vector, pa.array(block[some]), met], ["query_id", "dimension", "vector", "block", "met"])

    schema = "query_id bigint, dimension int, vector array<double>, block bigint, met array<array<int>>"
    return visits.select("query_id", "dimension", "vector", "visits").mapInArrow(run, schema)


def _best_of_block(k: int) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """For a block of rows and some queries: each query's ``k`` nearest among the rows of the buckets it visits there; without buckets, of all."""

    def best(_: tuple, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(asked):
            vectors = np.stack(rows["vector"].to_numpy()).astype(np.float64)
            unit, ids = _unit(vectors), rows["ids"].to_numpy()
            table_keys = np.array([[table[0] for table in keys] for keys in rows["keys"]], dtype=np.int64)
            order = [np.argsort(column, kind="stable") for column in table_keys.T]
            keys = [column[by] for column, by in zip(table_keys.T, order, strict=True)]
            numbered = [np.unique(column) for column in keys]
            queries = np.stack(asked["vector"].to_numpy()).astype(np.float64)
            mask, everything = np.zeros(len(rows), dtype=bool), np.arange(len(rows))
            for start in range(0, len(queries), 128):
                part = queries[start : start + 128]
                near_all = unit @ _unit(part).T
                for i, query in enumerate(part):
                    met = asked["met"].iloc[start + i]
                    if met is None:
                        at = everything
                    else:
                        at = merged_candidates(order, keys, [own[np.asarray(numbers, dtype=np.int64)] for own, numbers in zip(numbered, met, strict=True)], mask)
                    if not len(at):
                        continue
                    query_id, rough = asked["query_id"].iloc[start + i], near_all[at, i]
                    # A class may be the query's own row, so one more than k; sums differ in their last digits only.
                    cut = np.partition(rough, len(at) - k - 1)[len(at) - k - 1] - 1e-9 if len(at) > k + 1 else -2.0
                    close = at[rough >= cut]
                    near = [(-s, v) for s, some in zip(cosines(query, vectors[close]).tolist(), ids[close], strict=True) for v in some if v != query_id]
                    found += [(query_id, v, -s) for s, v in sorted(near)[:k]]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    return best


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Each query's ``k`` best, each candidate once."""
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", place).where(F.col("rank") <= k)


def nearest(
    table: DataFrame, is_query: Column, k: int = 5, id_column: str = "vec_id", vector_column: str = "embedding",
    tables: int = TABLES, projections: int | None = None, count: int = PROBES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query the ``k`` rows of greatest cosine that its probes find."""
    spark = table.sparkSession
    prepare(spark)
    number = F.col(vector_column).cast("array<double>")
    finite = F.forall(number, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(number, lambda x: x != 0)
    rows = table.select(F.col(id_column).cast("bigint").alias("id"), number.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(finite, F.lit(False)))

    # A candidate is a vector with the smallest ids that have it: k + 1, as one may be the query's own.
    some = Window.partitionBy("vector").orderBy("id")
    smallest = rows.select("id", "vector").distinct().withColumn("_n", F.row_number().over(some)).where(F.col("_n") <= k + 1)
    candidates = smallest.groupBy("vector").agg(F.array_sort(F.collect_list("id")).alias("ids")).withColumn("row", F.monotonically_increasing_id())
    candidates = stage(candidates, "candidates")
    asked = rows.where("asks").select("id", "vector").distinct().withColumn("row", F.monotonically_increasing_id())
    asked = stage(asked.withColumnRenamed("id", "query_id"), "asked")

    total, asking = candidates.count(), asked.count()
    many = projections or projections_for(total)
    near = typical_nearness(candidates, asked, k)

    def index(dimension: int, unit: np.ndarray) -> list:
        return buckets(unit, tables, many)[:, :, None].tolist()

    def visit(dimension: int, unit: np.ndarray) -> list:
        lists = []
        for i in range(0, len(unit), 64):
            keys, chance = likely_buckets(unit[i : i + 64], tables, many, count, near.get(dimension, NEAR))
            lists += [[k[w].tolist() for k, w in zip(own, use, strict=True)] for own, use in zip(keys, wanted(chance, tables), strict=True)]
        return lists

    indexed = _by_dimension(index, candidates).join(candidates, "row").withColumn("first", F.col("keys")[0][0])
    placed = global_rank(indexed, ["dimension", "first", "row"], "place").withColumn("block", F.floor(F.col("place") / SPLIT))
    placed = stage(placed.select("dimension", "block", "keys", "vector", "ids"), "blocks")
    # Where the rows of a bucket are stored: one row per bucket, with its places, which are its block and its number among the block's buckets.
    tabled = placed.select("dimension", "block", F.posexplode("keys").alias("table", "key")).select("dimension", "block", "table", F.col("key")[0].alias("key"))
    held = tabled.groupBy("dimension", "block", "table").agg(F.sort_array(F.collect_set("key")).alias("held"))
    numbered = held.select("dimension", "block", "table", F.posexplode("held").alias("number", "key")).withColumn("place", F.col("block") * SPLIT + F.col("number"))
    stored = stage(numbered.groupBy("dimension", "table", "key").agg(F.collect_list("place").alias("places")), "buckets")
    parts = max(1, -(-asking // TOGETHER))
    together = F.pmod(F.xxhash64("query_id"), F.lit(parts))
    by = ["dimension", "block", "part"]

    def search(met: DataFrame) -> DataFrame:
        """Best of the blocks for ``met`` (query_id, dimension, vector, block, met) rows of the queries."""
        there = stage(met.withColumn("part", together), "met")
        # A block goes to the parts of the queries that visit it.
        rows = placed.join(stage(there.select(*by).distinct(), "visits"), ["dimension", "block"])
        return rows.groupBy(*by).cogroup(there.groupBy(*by)).applyInPandas(_best_of_block(k), "query_id bigint, vec_id bigint, score double")

    visited = _by_dimension(visit, asked).select("row", "dimension", F.posexplode("keys").alias("table", "visits")).select("row", "dimension", "table", F.explode("visits").alias("key"))
    # Spark sizes the visits as if they were not exploded and the buckets by their packed file; neither may go through the driver.
    places = visited.hint("merge").join(stored, ["dimension", "table", "key"])
    # A query's visits (at most `count` a table) are one list; it is dealt out over the blocks with what lies there.
    visits = places.groupBy("row", "dimension").agg(F.collect_list(F.struct("table", "places")).alias("visits"))
    sized = asked.withColumn("dimension", F.size("vector")).hint("shuffle_hash")
    blocks = _dealt(visits.join(sized, ["row", "dimension"]), tables)
    found = stage(_ranked(search(blocks), k), "found")
    enough = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    short = asked.join(enough, "query_id", "left_anti")
    if not short.isEmpty():
        sized = short.select("query_id", F.size("vector").alias("dimension"), "vector")
        nothing = F.lit(None).cast(blocks.schema["met"].dataType)
        everywhere = sized.join(placed.select("dimension", "block").distinct(), "dimension").withColumn("met", nothing)
        found = _ranked(found.select("query_id", "vec_id", "score").union(search(everywhere)), k)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
