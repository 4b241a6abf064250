"""Near-duplicate classes by fast similarity sketching, banding and exact verification.

Method: words (A-Z lower-cased, split at ASCII blanks) give the set of distinct 5-word shingles, as 64-bit hashes. Fast
similarity sketching fills ``BINS`` coordinates: in round i every element is thrown into a hashed bin with the value
(i, hash); a bin keeps its least value; rounds go on until every bin is filled, and rounds ``BINS`` to ``2 * BINS`` aim at
one bin each, so that none stays empty. Bands of ``ROWS`` coordinates are the candidate buckets: a pair at the threshold
of 0.75 misses all 32 of them with a probability of 5 in a million. Every link is confirmed on the full sets:

1. Documents of one set are one node. In each bucket every node is held against the least node.
2. What is linked by then needs no further pair. Buckets that still hold several components, apart from the least node,
   are cut into chunks; each pair of chunks is one task group that compares its nodes as a product of
   shingle incidence matrices, and returns only the links that join components. So no link between components
   is lost, no bucket is capped, and the rows written stay linear in the nodes.
3. Components of all links; the smallest id of a component names it.

Results for odd input: a text of 1 to 4 words has their whole sequence as its one shingle. A NULL, empty or blank text
has none, and is alone. Rows with an equal id are rows of their own, each with the component of its text; a NULL
id takes part and names no component that has another id. An empty table gives an empty result. Columns other than id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.llm.common import as_column, components, map_batches, prepare, schema_of, words_of
from signal_lake.session import stage

WORDS = 5
BINS, ROWS = 128, 4
PERCENT = 75
#: Nodes of one bucket that meet in memory are at most twice as many.
CHUNK = 256
#: Word hashes a worker remembers.
KNOWN = 500_000
_EMPTY = np.iinfo(np.int64).max
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _Hashes()


def shingles(text: str | None, width: int = WORDS) -> np.ndarray:
    """The set of shingle hashes, sorted."""
    words = words_of(text, lower=True)
    if not words:
        return np.zeros(0, dtype=np.uint64)
    if len(_hashes) > KNOWN:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    n = min(width, len(h))
    total = np.full(len(h) - n + 1, np.uint64(n))
    for k in range(n):
        total = _mixed(total * _MIX[3] + h[k : len(h) - n + 1 + k] * _MIX[0])
    total.sort()
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """A sketch per set, row by row; rows of empty sets stay unfilled."""
    sizes = np.array([len(s) for s in sets])
    out = np.full((len(sets), bins), _EMPTY, dtype=np.int64)
    flat = np.concatenate(sets) if len(sets) else np.zeros(0, dtype=np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    seeds = np.arange(1, 2 * bins + 1, dtype=np.uint64) * _MIX[4]
    for i in range(2 * bins):
        if not len(flat):
            break
        h = _mixed(flat + seeds[i])
        at = (h >> np.uint64(32)) % np.uint64(bins) if i < bins else np.full(len(h), i - bins, dtype=np.uint64)
        value = (h & np.uint64(0xFFFFFFFF)).astype(np.int64) | (i << 32)
        np.minimum.at(out.reshape(-1), owner * bins + at.astype(np.int64), value)
        open_ = (out == _EMPTY).any(axis=1)
        if not open_[owner[0]] or not open_[owner].all():
            keep = open_[owner]
            flat, owner = flat[keep], owner[keep]
    return out


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """Bucket keys of each sketch; the band's number is part of the key."""
    parts = sketch.astype(np.uint64).reshape(len(sketch), -1, rows)
    key = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64) * _MIX[4], parts.shape[:2])
    for k in range(rows):
        key = _mixed(key * _MIX[3] + parts[:, :, k])
    return key.astype(np.int64)


def _digest(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _prints(batch: pa.RecordBatch) -> pa.RecordBatch:
    sets = [shingles(t) for t in batch.column(1).to_pylist()]
    keys = bands(sketches(sets))
    lists = pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * keys.shape[1], pa.array(keys.reshape(-1)))
    return pa.record_batch(
        [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([_digest(s) for s in sets], pa.binary()), lists],
        ["id", "n_shingles", "content", "bands"],
    )


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Sets of the texts that belong to the node; another text may have the same id."""
    node, content, texts = (c.to_pylist() for c in batch.columns)
    found = [(n, s) for n, c, t in zip(node, content, texts, strict=True) if _digest(s := shingles(t)) == c]
    return pa.record_batch([pa.array([n for n, _ in found], pa.int64()), pa.array([s.astype(np.int64) for _, s in found], pa.list_(pa.int64()))], ["node", "elements"])


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all ``left`` with all ``right`` sets, as a product of incidence matrices by blocks of elements."""
    both = np.concatenate([*left, *right])
    values, number, times = np.unique(both, return_inverse=True, return_counts=True)
    rank = np.full(len(values), -1)
    common = np.flatnonzero(times > 1)
    rank[common] = np.arange(len(common))
    column = rank[number]
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    row, column = row[column >= 0], column[column >= 0]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(left), len(right)), dtype=np.float64)
    for start in range(0, len(common), 4096):
        a, b = np.searchsorted(column, [start, start + 4096])
        part = np.zeros((len(left) + len(right), min(4096, len(common) - start)), dtype=np.float32)
        part[row[a:b], column[a:b] - start] = 1
        out += part[: len(left)] @ part[len(left) :].T
    return out


def _joining_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links of one pair of chunks that join components, at most one less than it has components."""
    side = group["chunk"].to_numpy()
    low, high = group["low"].iloc[0], group["high"].iloc[0]
    sets = [np.asarray(s, dtype=np.int64) for s in group["elements"]]
    node, component = group["node"].to_numpy(), group["component"].to_numpy()
    left, right = np.flatnonzero(side == low), np.flatnonzero(side == high)
    sizes = np.array([len(s) for s in sets])
    parent = {c: c for c in component.tolist()}

    def root(c: int) -> int:
        while parent[c] != c:
            parent[c] = c = parent[parent[c]]
        return c

    found = []
    if len(left) and len(right) and len(parent) > 1:
        inter = shared([sets[i] for i in left], [sets[i] for i in right])
        union = sizes[left][:, None] + sizes[right][None, :] - inter
        near = (100 * inter >= PERCENT * union) & (component[left][:, None] != component[right][None, :])
        for i, j in zip(*np.nonzero(near), strict=True):
            a, b = root(int(component[left[i]])), root(int(component[right[j]]))
            if a != b:
                parent[max(a, b)] = min(a, b)
                found.append((node[left[i]], node[right[j]]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are near."""
    with_b = pairs.join(sets.select(F.col("node").alias("b"), F.col("elements").alias("_b")), "b")
    both = with_b.join(sets.select(F.col("node").alias("a"), F.col("elements").alias("_a")), "a")
    inter = F.size(F.array_intersect("_a", "_b"))
    total = F.size("_a") + F.size("_b")
    return both.where(100 * inter >= PERCENT * (total - inter)).select("a", "b")


def near_duplicates(docs: DataFrame, id_column: Column | str = "doc_id", text_column: Column | str = "text") -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row of ``docs``; the id may be of any type that has an order."""
    prepare(docs.sparkSession)
    rows = docs.select(as_column(id_column).alias("id"), as_column(text_column).alias("text"))
    prints = stage(map_batches(rows, _prints, schema_of(rows, ["id"], "n_shingles bigint, content binary, bands array<bigint>")), "prints")

    found = prints.where("n_shingles > 0").groupBy("content").agg(
        F.min("id").alias("id"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    nodes = stage(found.withColumn("node", F.monotonically_increasing_id()), "nodes")

    keyed = nodes.select("node", "n", F.explode("bands").alias("key"))
    crowded = keyed.groupBy("key").agg(F.min("node").alias("center"), F.count("*").alias("members")).where("members > 1")
    members = stage(keyed.join(crowded, "key").select("key", "node", "n", "center", "members"), "members")

    pairs = members.where("node <> center").select(F.col("center").alias("a"), F.col("node").alias("b"), F.col("n").alias("nb")).distinct()
    size = nodes.select(F.col("node").alias("a"), F.col("n").alias("na"))
    pairs = pairs.join(size, "a").where((100 * F.least("na", "nb") >= PERCENT * F.greatest("na", "nb"))).select("a", "b")
    wanted = members.select("node").distinct().join(nodes.select("node", "id", "content"), "node")
    texts = wanted.join(rows.withColumnRenamed("id", "_id"), F.col("id").eqNullSafe(F.col("_id")))
    sets = map_batches(texts.select("node", "content", "text"), _sets, "node bigint, elements array<bigint>")
    sets = stage(sets.dropDuplicates(["node"]), "sets")
    linked = stage(_confirmed(pairs, sets), "linked")

    # Second step: pairs of nodes in different components that both differ from their bucket's least node.
    first = components(linked)
    others = members.where("node <> center").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    undecided = others.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("rest"))
    undecided = undecided.where("low <> high").select("key", F.ceil(F.col("rest") / CHUNK).alias("chunks"))
    chunked = others.join(undecided, "key").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    chunked = chunked.select("key", "node", "component", "chunk", "chunks").join(sets, "node")
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
    spread = chunked.withColumn("other", other).withColumns({"low": F.least("chunk", "other"), "high": F.greatest("chunk", "other")})
    spread = spread.select("key", "low", "high", "chunk", "node", "component", "elements")
    joining = spread.groupBy("key", "low", "high").applyInPandas(_joining_links, "a bigint, b bigint")
    links = stage(linked.union(joining), "links")

    grouped = components(links)
    labelled = nodes.select("node", "content", "id").join(grouped, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    named = labelled.join(least, "component").select("content", "component_id")
    result = prints.select("id", "n_shingles", "content").join(named, "content", "left")
    alone = F.col("n_shingles") == 0
    result = result.withColumn("component_id", F.when(alone, F.col("id")).otherwise(F.col("component_id")))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull())
    return result.select(F.col("id").alias(id_column if isinstance(id_column, str) else "id"), "n_shingles", "component_id", kept.alias("kept"))
