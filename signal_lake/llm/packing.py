"""Packing of tokenised documents into sequences of one size.

Method: shortest-pack-first over the length histogram. A document's ids and a closing id are cut into full sequences
and one rest. The histogram of piece lengths (at most ``size`` numbers, whatever the input) goes to the driver, where
lengths are placed longest first, each into the packs with the most room left; what is kept are packing patterns and
how many packs have each, not documents. A pattern's places are intervals of ranks of a length; pieces are ranked
within their length over all rows and join the interval that holds their rank.

Results for odd input: a NULL or empty text is the closing id alone. Repeated rows are packed once each. An empty table
gives no pieces. Columns other than id and text are not read.
"""

from __future__ import annotations

import base64
import heapq
import json
import re
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.llm.common import as_column, blocks_for, map_batches, prepare, schema_of, with_rank
from signal_lake.session import stage

SIZE = 1024
CLOSE = 0
#: Characters whose class is the same in every Unicode version; texts of these alone go the faster way.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ‐-‧]*")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Tokens:
    """Ids of a byte-level vocabulary file, as tokenizers gives them; the string of a special token in a text is that token.

    The same vocabulary runs about four times as fast in tiktoken, if the rank file that belongs to it is there; texts with
    rarer characters, which the libraries might class differently, or with special tokens go through tokenizers.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.special = [t["content"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]]
        self.fast = self._ranked(path)

    def _ranked(self, path: str):
        try:
            lines = open(path.removesuffix(".json") + ".tiktoken", "rb").read().split(b"\n")
        except FileNotFoundError:
            return None
        import public_tokenizers
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line)}
        special = {t["id"] for t in json.load(open(path, encoding="utf-8"))["added_tokens"]}
        if len(ranks) != len(set(self.slow.get_vocab().values()) - special):
            return None
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        plain = [self.fast is not None and _PLAIN.fullmatch(t) is not None and not any(s in t for s in self.special) for t in texts]
        rest = iter(self.slow.encode_batch([t for t, p in zip(texts, plain, strict=True) if not p], add_special_tokens=False))
        return [
            np.asarray(self.fast.encode_ordinary(t) if p else next(rest).ids, dtype="<u4")
            for t, p in zip(texts, plain, strict=True)
        ]


@lru_cache(maxsize=2)
def tokens(path: str) -> Tokens:
    """One tokenizer per worker process."""
    return Tokens(path)


def cut(docs: DataFrame, id_column: Column | str, text_column: Column | str, tokenizer: str | None, size: int, keep_ids: bool) -> DataFrame:
    """A row per piece: (id, start, length, ids_crc32, doc_tokens), and its ids if asked for."""
    path = tokenizer or default_tokenizer()
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * keep_ids]

    def pieces(batch: pa.RecordBatch) -> pa.RecordBatch:
        owner, rows, ids = [], [], []
        for i, found in enumerate(tokens(path).encode([t or "" for t in batch.column(1).to_pylist()])):
            whole = np.append(found, np.uint32(CLOSE)).astype("<u4")
            for start in range(0, len(whole), size):
                piece = whole[start : start + size]
                owner.append(i)
                rows.append((start, len(piece), zlib.crc32(piece.tobytes()), len(whole)))
                if keep_ids:
                    ids.append(piece.astype(np.int32))
        numbers = [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)]
        lists = [pa.array(ids, pa.list_(pa.int32()))] * keep_ids
        return pa.record_batch([batch.column(0).take(pa.array(owner)), *numbers, *lists], names)

    rows = docs.select(as_column(id_column).alias("id"), as_column(text_column).alias("text"))
    fields = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint" + ", ids array<int>" * keep_ids
    return map_batches(rows, pieces, schema_of(rows, ["id"], fields))


def shortest_pack_first(histogram: dict[int, int], size: int = SIZE) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths, in order) and the number of packs of each."""
    by_room: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []  # a heap of the rooms that may be in by_room, greatest first

    def put(room: int, pattern: tuple[int, ...], count: int) -> None:
        if room not in by_room:
            by_room[room] = []
            heapq.heappush(rooms, -room)
        by_room[room].append((pattern, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while rooms and -rooms[0] not in by_room:
                heapq.heappop(rooms)
            if not rooms or -rooms[0] < length:
                put(size - length, (length,), left)
                break
            room = -rooms[0]
            pattern, count = by_room[room].pop()
            if not by_room[room]:
                del by_room[room]
                heapq.heappop(rooms)
            took = min(left, count)
            if took < count:
                put(room, pattern, count - took)
            put(room - length, (*pattern, length), took)
            left -= took
    return [x for room in sorted(by_room) for x in sorted(by_room[room])]


def intervals(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset) for each place of each pattern."""
    rows, used, sequence = [], {}, 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            first = used.get(length, 0)
            rows.append((length, first, first + count, sequence, offset))
            used[length] = first + count
            offset += length
        sequence += count
    return rows


def pack(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", tokenizer: str | None = None, size: int = SIZE, keep_ids: bool = False
) -> DataFrame:
    """A row per piece with its sequence_id and offset there; sequences are numbered from 0 without gaps."""
    spark = docs.sparkSession
    prepare(spark)
    pieces = cut(docs, id_column, text_column, tokenizer, size, keep_ids)
    pieces = stage(pieces.withColumn("piece", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = intervals(shortest_pack_first(histogram, size))
    # Patterns come from at most `size` lengths, so their places are some thousand rows for any number of documents.
    table = spark.createDataFrame(places, "length bigint, first bigint, past bigint, base bigint, offset bigint")
    ranked = with_rank(pieces, ["length"], "piece", "rank", blocks_for(sum(histogram.values())))
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("past"))
    placed = ranked.join(F.broadcast(table).withColumnRenamed("length", "_length"), (F.col("length") == F.col("_length")) & inside)
    placed = placed.withColumn("sequence_id", F.col("base") + F.col("rank") - F.col("first"))
    return placed.drop("piece", "rank", "_length", "first", "past", "base").withColumnRenamed("id", id_column)
