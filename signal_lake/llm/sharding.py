"""Sharding by balanced label propagation.

Method: documents that belong to one link (here: have one text) should meet in one shard. Every linked row starts in a shard of its own hash, so links
are cut all over. The rows of a link are a unit (a row of several links belongs to the least); in each round a join tells every unit how
many neighbours it has in each shard, and it wishes to go to the shard with most among those that have room for all of it. Wishes
into a shard are granted as far as its quota goes: what units that have settled leave of its capacity. Those turned away wish anew in the next
round, until none is left or none can be granted. Larger units go first, class by class of half the size, since they find room
more rarely. What then fits nowhere whole is laid across the room that is left, and rows without a link fill the shards up, so that
all have the same number of rows, give or take one (law ``rows``). A link larger than a shard is first cut into parts that fill one each.

State between rounds is one row per unit, link and shard, however many rows a unit has; the driver sees sums by shard.

Results for odd input: a NULL text counts as an empty one (size 1, checksum 0). NULL links count as none. Rows with an equal id
are rows of their own. An empty table gives an empty result. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.llm.common import blocks_for, lookup_salted, prepare, with_rank
from signal_lake.session import stage

SHARDS = 16
#: Rounds of one class of sizes, and classes above the one that holds all units.
ROUNDS, CLASSES = 10, 6


def _shard_of(place: Column, bounds: Sequence[int]) -> Column:
    """Shard whose interval of places, from ``bounds[s]`` on, holds ``place``."""
    return F.coalesce(*[F.when(place < bounds[s + 1], F.lit(s)) for s in range(len(bounds) - 1)])


def cut_edges(spread: DataFrame) -> int:
    """Pairs of rows of one link that lie in different shards."""
    tally = spread.groupBy("link", "shard").agg(F.sum("w").alias("n"))
    cut = tally.groupBy("link").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).cast("decimal(38,0)").alias("cut"))
    return int(cut.agg(F.sum("cut")).first()[0] or 0)


def _round(spread: DataFrame, active: DataFrame, room: np.ndarray, blocks: int) -> DataFrame:
    """(unit, size, target) of the wishes of ``active`` (unit, size) units that are granted."""
    tally = spread.groupBy("link", "shard").agg(F.sum("w").alias("n"))
    part = spread.join(active.select("unit"), "unit", "left_semi").groupBy("unit", "link").agg(F.sum("w").alias("w"))
    near = part.join(tally, "link").groupBy("unit", "shard").agg(F.sum((F.col("w") * F.col("n")).cast("decimal(38,0)")).alias("near"))
    rooms = F.explode(F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(int(x)).alias("room")) for s, x in enumerate(room)])).alias("r")
    fits = active.select("unit", "size", rooms).select("unit", "size", "r.*").where("size <= room")
    voted = fits.join(near, ["unit", "shard"], "left")
    first = F.struct(F.coalesce("near", F.lit(0).cast("decimal(38,0)")).alias("near"), F.xxhash64("unit", "shard").alias("tie"))
    wishes = voted.groupBy("unit", "size").agg(F.max_by(F.struct("shard", "room"), first).alias("best")).select("unit", "size", F.col("best.shard").alias("target"), "best.room")
    ranked = with_rank(stage(wishes, "wishes"), ["target"], "unit", "rank", blocks, F.col("size"))
    return ranked.where("rank + size <= room").select("unit", "size", "target")


def propagate(spread: DataFrame, sizes: DataFrame, capacity: np.ndarray, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray, list[int]]:
    """((unit, shard) of the units that have settled, room left, cut edges before the first and after each round).

    ``spread`` holds how many rows (w) of a unit have a link and start in a shard, ``sizes`` the rows of each unit.
    """
    spark = spread.sparkSession
    room = capacity.astype(np.int64).copy()
    blocks = blocks_for(sizes.count())
    greatest = sizes.agg(F.max("size")).first()[0] or 0
    settled = spark.createDataFrame([], "unit bigint, shard int")
    open_, cuts = sizes, [cut_edges(spread)]
    for least in [int(capacity.max()) >> k for k in range(1, CLASSES + 1)] + [0]:
        if least >= greatest:
            continue
        for _ in range(rounds):
            active = open_.where(F.col("size") > least)
            granted = stage(_round(spread, active, room, blocks), "granted")
            taken = granted.groupBy("target").agg(F.sum("size").alias("n")).collect()
            if not taken:
                break
            for r in taken:
                room[r["target"]] -= r["n"]
            settled = settled.union(granted.select("unit", F.col("target").alias("shard")))
            open_ = stage(open_.join(granted.select("unit"), "unit", "left_anti"), "open")
            moved = spread.join(granted.select("unit", "target"), "unit", "left").withColumn("shard", F.coalesce("target", "shard"))
            spread = stage(moved.groupBy("unit", "link", "shard").agg(F.sum("w").alias("w")), "spread")
            cuts.append(cut_edges(spread))
    return settled, room, cuts


def _parts(links: DataFrame, capacity: int, blocks: int) -> DataFrame:
    """``links`` with those above a shard's capacity cut into parts that just fill one."""
    large = links.groupBy("link").agg(F.count("*").alias("n")).where(F.col("n") > capacity).select("link")
    large = F.broadcast(stage(large, "over"))  # no more than there are shards
    inside = stage(links.join(large, "link", "left_semi"), "large")
    if inside.isEmpty():
        return links
    part = F.xxhash64("link", F.floor(F.col("rank") / capacity))
    cut = with_rank(inside, ["link"], "row", "rank", blocks).select("row", part.alias("link"))
    return links.join(large, "link", "left_anti").select("row", "link").union(cut)


def start_of(row: str = "row", shards: int = SHARDS) -> Column:
    """Where a linked row starts."""
    return F.pmod(F.xxhash64(row), F.lit(shards)).cast("int")


def units_of(links: DataFrame, shards: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(staged (row, unit), staged spread, staged sizes) of rows with their links; a row's unit is its least link."""
    own = stage(links.groupBy("row").agg(F.min("link").alias("unit")), "units")
    if links.count() == own.count():  # one link a row: no join is needed to tell a row's unit
        counted = links.select(F.col("link").alias("unit"), "link", start_of("row", shards).alias("shard"))
    else:
        counted = links.join(own, "row").select("unit", "link", start_of("row", shards).alias("shard"))
    spread = stage(counted.groupBy("unit", "link", "shard").agg(F.count("*").alias("w")), "spread")
    return own, spread, stage(own.groupBy("unit").agg(F.count("*").alias("size")), "sizes")


def shard_rows(rows: DataFrame, links: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(row, shard, slot) of all ``rows`` (row), linked by ``links`` (row, link); sizes differ by one at most."""
    total = rows.count()
    capacity = np.array([total // shards + (s < total % shards) for s in range(shards)])
    blocks = blocks_for(total)
    links = stage(_parts(links.where("link IS NOT NULL"), max(1, int(capacity.min())), blocks), "links")
    own, spread, sizes = units_of(links, shards)
    settled, room, _ = propagate(spread, sizes, capacity, rounds)
    settled = stage(settled, "settled")
    stay = lookup_salted(own, settled, ["unit"], ["row"]).select("row", "shard")

    # Units that fit nowhere whole lie one after the other along the room that is left.
    bounds = np.concatenate([[0], np.cumsum(room)]).tolist()
    loose = stage(sizes.join(settled, "unit", "left_anti"), "loose")
    if not loose.isEmpty():
        begins = with_rank(loose, [], "unit", "at", blocks, F.col("size")).select("unit", "at")
        ranked = with_rank(lookup_salted(own, begins, ["unit"], ["row"]), ["unit"], "row", "rank", blocks)
        stay = stay.union(ranked.select("row", _shard_of(F.col("at") + F.col("rank"), bounds).alias("shard")))
    stay = stage(stay, "stay")
    held = np.zeros(shards, dtype=np.int64)
    for r in stay.groupBy("shard").agg(F.count("*").alias("n")).collect():
        held[r["shard"]] = r["n"]

    # Rows without a link are dealt to the room that is left.
    bounds = np.concatenate([[0], np.cumsum(capacity - held)]).tolist()
    free = stage(rows.select("row").join(stay, "row", "left_anti"), "free")
    free = with_rank(free, [], "row", "rank", blocks).select("row", _shard_of(F.col("rank"), bounds).alias("shard"))
    return with_rank(stage(stay.union(free), "sharded"), ["shard"], "row", "slot", blocks)


def shard_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shards: int = SHARDS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard); rows with one text are linked."""
    prepare(docs.sparkSession)
    text = F.coalesce(F.col(text_column), F.lit(""))
    narrow = docs.select(
        F.col(id_column).alias("id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.sha2(text, 256)).alias("content")
    )
    narrow = stage(narrow.withColumn("row", F.monotonically_increasing_id()), "narrow")
    groups = narrow.groupBy("content").agg(F.count("*").alias("n"), F.min("row").alias("link")).where("n > 1").select("content", "link")
    links = lookup_salted(narrow.select("row", "content"), groups, ["content"], ["row"]).select("row", "link")
    placed = shard_rows(narrow, links, shards)
    return narrow.join(placed, "row").select(
        F.col("id").alias(id_column), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard")
    )
