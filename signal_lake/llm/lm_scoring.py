"""Language-model scores of texts: n-grams by deleted interpolation.

Method: maximum-likelihood estimates of all orders up to ``order`` are mixed: P(w | h) = weight * count(h w) / count(h) + (1 - weight) * P(w |
shorter h), down to 1 / (V + 1), the share of any word of V known ones or of an unknown one. The weight depends on the order and on the
bucket of the context's count (its power of two). One part in ten of the training texts is deleted from the counts, and
expectation-maximisation finds the weights under which the other counts give these texts the greatest likelihood; then
all training texts are counted. Counts are exact and complete: words go by their bytes, longer n-grams by hashes of 64 bits, of which two
meet with a probability of n ** 2 / 2 ** 65. A context that was never seen leaves all to the shorter one. The beginning of a text is a context too.

How it runs: texts become blocks of word numbers. Each block sends its different n-grams, one packed row per part of the space of hashes, so
a frequent word is one entry a block however often it occurs. A part adds up what blocks sent and answers each block with
the totals of its own n-grams; no table of n-grams is broadcast or kept in one place. Weights are found on a table of different
(counts, counts of contexts); a round of it gives one row per order and bucket to the driver.

Results for odd input: a NULL or empty text is its end alone. A NULL id belongs to the training texts. Repeated rows count and are scored as often
as they occur. Without training texts every token has probability 1. Without deleted texts weights stay at one half. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from signal_lake.llm.common import as_column, prepare
from signal_lake.llm.token_blocks import (
    BLOCK_TOKENS, Block, joined_hash, pack_ints, pack_sorted, pack_words, share_of, unpack_ints, unpack_sorted, unpack_words, word_hashes,
)
from signal_lake.session import stage

ORDER = 2
ADDED = 0.1
#: N-grams that a task adds up at a time.
PART_KEYS = 1 << 20
ROUNDS, ENOUGH = 25, 1e-5
KEPT, DELETED, HELD_OUT = 0, 1, 2
BUCKETS = 64


def held_out(id_column: Column) -> Column:
    """Rows that teach nothing: one part in ten, by a hash of the id."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 10 == 0, F.lit(False))


def _blocks(docs: DataFrame, id_column: Column, text_column: Column, block_tokens: int) -> DataFrame:
    """Staged rows (block, kind, ids, lengths, size, tokens, words); a block holds texts of one kind."""
    deleted = F.pmod(F.xxhash64(F.lit("deleted"), id_column.cast("string")), F.lit(10)) == 1
    kind = F.when(held_out(id_column), HELD_OUT).when(deleted, DELETED).otherwise(KEPT)
    rows = docs.select(id_column.alias("id"), kind.alias("kind"), text_column.cast("binary").alias("text"))
    schema = StructType([StructField("ids", ArrayType(rows.schema["id"].dataType)), *StructType.fromDDL("kind int, lengths binary, size bigint, tokens binary, words binary").fields])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {kind: (Block(), [], []) for kind in (KEPT, DELETED, HELD_OUT)}
        id_type = None

        def flush(kind: int) -> pa.RecordBatch:
            block, ids, lengths = held[kind]
            size = block.size
            tokens, words = block.take()
            made = pa.record_batch(
                [pa.array([ids], pa.list_(id_type)), pa.array([kind], pa.int32()), pa.array([pack_ints(np.array(lengths))]),
                 pa.array([size], pa.int64()), pa.array([tokens], pa.binary()), pa.array([words], pa.binary())],
                ["ids", "kind", "lengths", "size", "tokens", "words"],
            )
            ids.clear()
            lengths.clear()
            return made

        for batch in batches:
            id_type = batch.column(0).type
            for number, kind, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = (text or b"").lower().split()
                words.append(b"")
                block, ids, lengths = held[kind]
                block.add(words)
                ids.append(number)
                lengths.append(len(words))
                if block.size >= block_tokens:
                    yield flush(kind)
        for kind, (block, _, _) in held.items():
            if block.size:
                yield flush(kind)

    return stage(rows.mapInArrow(write, schema).withColumn("block", F.monotonically_increasing_id()), "lm_blocks")


def _keys(tokens: np.ndarray, hashes: np.ndarray, order: int) -> list[np.ndarray]:
    """Hash of the m-gram that ends at each token, for m from 2; a context is cut at the beginning of its text."""
    starts = np.concatenate([[True], tokens[:-1] == 0])[: len(tokens)]
    own = hashes[tokens]
    keys, shorter = [], own
    for m in range(2, order + 1):
        context = np.concatenate([np.zeros(1, np.uint64), shorter[:-1]])[: len(tokens)]
        shorter = joined_hash(np.where(starts, np.uint64(m), context), own)
        keys.append(shorter)
    return keys


def _chunks(blocks: DataFrame, parts: int, order: int) -> DataFrame:
    """What each block asks of each part: its words and n-grams there, and how often it has them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, kind, tokens, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names, at = unpack_words(words), unpack_ints(tokens)
                hashes = word_hashes(names)
                place = share_of(hashes, parts)
                by_part = np.argsort(place, kind="stable")
                levels = [(by_part, place[by_part], np.bincount(at, minlength=len(names))[by_part])]
                for keys in _keys(at, hashes, order):
                    found, n = np.unique(keys, return_counts=True)
                    levels.append((found, share_of(found, parts), n))
                edges = [np.searchsorted(p, np.arange(parts + 1)) for _, p, _ in levels]
                used = np.flatnonzero(sum(np.diff(e) for e in edges))
                asked, counted = [], []
                for part in used.tolist():
                    cuts = [slice(e[part], e[part + 1]) for e in edges]
                    some = [names[i] for i in levels[0][0][cuts[0]].tolist()]
                    asked.append([pack_words(some) if some else b"", *(pack_sorted(found[c]) for (found, _, _), c in zip(levels[1:], cuts[1:], strict=True))])
                    counted.append([pack_ints(n[c]) if kind != HELD_OUT else b"" for (_, _, n), c in zip(levels, cuts, strict=True)])
                yield pa.record_batch(
                    [pa.array(used, pa.int32()), pa.array(np.full(len(used), number), pa.int64()), pa.array(np.full(len(used), kind), pa.int32()),
                     pa.array(asked, pa.list_(pa.binary())), pa.array(counted, pa.list_(pa.binary()))],
                    ["part", "block", "kind", "asked", "counted"],
                )

    return blocks.select("block", "kind", "tokens", "words").mapInArrow(emit, "part int, block bigint, kind int, asked array<binary>, counted array<binary>")


def _totals(chunks: DataFrame, order: int) -> DataFrame:
    """For each chunk the counts of its n-grams in all training texts, and in the deleted ones; for each part (block -1) tokens and words."""

    def add_up(table: pa.Table) -> pa.Table:
        kinds, blocks = table["kind"].to_pylist(), table["block"].to_pylist()
        asked, counted = table["asked"].to_pylist(), table["counted"].to_pylist()
        answers: list[list[bytes]] = [[] for _ in blocks]
        tokens = deleted_tokens = known = 0
        for m in range(order):
            if m == 0:
                numbers: dict[bytes, int] = {}
                lists = [unpack_words(a[0]) if a[0] else [] for a in asked]
                at = [np.fromiter((numbers.setdefault(w, len(numbers)) for w in some), np.int64, len(some)) for some in lists]
                size = len(numbers)
            else:
                lists = [unpack_sorted(a[m]) for a in asked]
                found, where = np.unique(np.concatenate(lists), return_inverse=True)
                at = np.split(where, np.cumsum([len(x) for x in lists])[:-1])
                size = len(found)
            total, deleted = np.zeros(size, np.int64), np.zeros(size, np.int64)
            for places, kind, n in zip(at, kinds, counted, strict=True):
                if kind != HELD_OUT:
                    total[places] += unpack_ints(n[m])  # a chunk has each key once
                if kind == DELETED:
                    deleted[places] += unpack_ints(n[m])
            if m == 0:
                tokens, deleted_tokens, known = int(total.sum()), int(deleted.sum()), int((total > 0).sum())
            for answer, places, kind in zip(answers, at, kinds, strict=True):
                answer += [pack_ints(total[places]), pack_ints(deleted[places]) if kind == DELETED else b""]
        n = len(blocks)
        return pa.table({
            "block": pa.array([*blocks, -1], pa.int64()), "kind": pa.array([*kinds, -1], pa.int32()), "part": pa.array([table["part"][0].as_py()] * (n + 1), pa.int32()),
            "answer": pa.array([*answers, None], pa.list_(pa.binary())), "tokens": pa.array([None] * n + [tokens], pa.int64()),
            "deleted_tokens": pa.array([None] * n + [deleted_tokens], pa.int64()), "known": pa.array([None] * n + [known], pa.int64()),
        })

    fields = "block bigint, kind int, part int, answer array<binary>, tokens bigint, deleted_tokens bigint, known bigint"
    return stage(chunks.groupBy("part").applyInArrow(add_up, fields), "lm_totals")


def _looked_up(block: dict, table: pa.Table, parts: int, order: int, kept_only: bool) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(numbers, counts, counts of contexts) at each token of a block, orders from 1; the context of order 1 is left to the caller."""
    names, at = unpack_words(block["words"]), unpack_ints(block["tokens"])
    hashes = word_hashes(names)
    answers = [a for _, a in sorted(zip(table["part"].to_pylist(), table["answer"].to_pylist(), strict=True))]

    def all_of(level: int) -> np.ndarray:
        counts = np.concatenate([unpack_ints(a[2 * level]) for a in answers])
        return counts - np.concatenate([unpack_ints(a[2 * level + 1]) for a in answers]) if kept_only else counts

    of_word = np.empty(len(names), np.int64)
    of_word[np.argsort(share_of(hashes, parts), kind="stable")] = all_of(0)
    counts, contexts = [of_word[at]], [np.zeros(0, np.int64)]
    starts = np.concatenate([[True], at[:-1] == 0])
    for level, keys in enumerate(_keys(at, hashes, order), 1):
        _, where = np.unique(keys, return_inverse=True)
        contexts.append(np.where(starts, of_word[0], np.concatenate([[0], counts[-1][:-1]])))
        counts.append(all_of(level)[where])
    return at, counts, contexts


def _bucket(context: np.ndarray) -> np.ndarray:
    """Power of two of a count from 1."""
    return np.frexp(np.maximum(context, 1).astype(np.float64))[1] - 1


def mixed(counts: list[np.ndarray], contexts: list[np.ndarray], weights: np.ndarray, words: int) -> list[np.ndarray]:
    """Probabilities by all orders from 0; ``weights`` by order from 1 and bucket."""
    found = [np.full(len(counts[0]), 1.0 / (words + 1))]
    for own, n, weight in zip(counts, contexts, weights, strict=True):
        share = np.where(n > 0, weight[_bucket(n)], 0.0)
        found.append(share * own / np.maximum(n, 1) + (1 - share) * found[-1])
    return found


def learn_weights(evidence: DataFrame, order: int, kept_tokens: int, words: int) -> np.ndarray:
    """Weights by order and bucket, by expectation-maximisation on staged rows (c1, c2, n2, ..., times).

    Half a count each way keeps weights off 0 and 1, so an unknown word never has probability 0.
    """
    spark = evidence.sparkSession
    weights, before = np.full((order, BUCKETS), 0.5), None
    fields = "level int, bucket int, taken double, passed double, likelihood double"
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(weights)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            taken, passed, likelihood = np.zeros((order, BUCKETS)), np.zeros((order, BUCKETS)), 0.0
            for batch in batches:
                columns = {name: column.to_numpy() for name, column in zip(batch.schema.names, batch.columns, strict=True)}
                times = columns["times"].astype(np.float64)
                counts = [columns[f"c{m}"] for m in range(1, order + 1)]
                contexts = [np.full(len(times), kept_tokens), *(columns[f"n{m}"] for m in range(2, order + 1))]
                chances = mixed(counts, contexts, shared.value, words)
                likelihood += float((times * np.log(chances[-1])).sum())
                mass = times
                for m in range(order, 0, -1):
                    n, bucket = contexts[m - 1], _bucket(contexts[m - 1])
                    weight = np.where(n > 0, shared.value[m - 1][bucket], 0.0)
                    own = mass * weight * counts[m - 1] / np.maximum(n, 1) / chances[m]
                    rest = mass - own
                    seen = n > 0
                    taken[m - 1] += np.bincount(bucket[seen], own[seen], BUCKETS)
                    passed[m - 1] += np.bincount(bucket[seen], rest[seen], BUCKETS)
                    mass = rest
            level, bucket = np.nonzero(taken + passed)
            level, bucket = np.append(level, -1), np.append(bucket, 0)
            yield pa.record_batch(
                [pa.array(level, pa.int32()), pa.array(bucket, pa.int32()), pa.array(taken[level, bucket]), pa.array(passed[level, bucket]),
                 pa.array([*[0.0] * (len(level) - 1), likelihood])],
                ["level", "bucket", "taken", "passed", "likelihood"],
            )

        sums = evidence.mapInArrow(expect, fields).groupBy("level", "bucket").agg(*[F.sum(c).alias(c) for c in ("taken", "passed", "likelihood")]).collect()
        weights, now = np.full((order, BUCKETS), 0.5), 0.0
        for row in sums:
            if row["level"] < 0:
                now = row["likelihood"]
            else:
                weights[row["level"], row["bucket"]] = (row["taken"] + 0.5) / (row["taken"] + row["passed"] + 1)
        if before is not None and now - before <= ENOUGH * abs(before):
            break
        before = now
    return weights


def score_documents(
    docs: DataFrame, id_column: Column | str = "doc_id", text_column: Column | str = "text", name: str = "doc_id",
    order: int = ORDER, block_tokens: int = BLOCK_TOKENS, part_keys: int = PART_KEYS,
) -> DataFrame:
    """(id as ``name``, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row."""
    spark = docs.sparkSession
    prepare(spark)
    blocks = _blocks(docs, as_column(id_column), as_column(text_column), block_tokens)
    size = blocks.agg(F.sum("size")).first()[0] or 0
    parts = min(max(8, -(-size * order // part_keys)), (1 << 31) - 1)
    totals = _totals(_chunks(blocks, parts, order), order)
    of_all = totals.where("block = -1").agg(F.sum("tokens"), F.sum("deleted_tokens"), F.sum("known")).first()
    tokens, deleted_tokens, words = (x or 0 for x in of_all)
    names = ["c1", *(f"{x}{m}" for m in range(2, order + 1) for x in "cn")]

    def observe(left: pa.Table, right: pa.Table) -> pa.Table:
        """The different counts at the tokens of a deleted block, and how often each occurs."""
        if not left.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in (*names, "times")})
        _, counts, contexts = _looked_up(left.to_pylist()[0], right, parts, order, kept_only=True)
        columns = np.stack([counts[0], *(x for pair in zip(counts[1:], contexts[1:], strict=True) for x in pair)])
        columns = columns[:, np.lexsort(columns)]
        first = np.flatnonzero(np.concatenate([[True], (columns[:, 1:] != columns[:, :-1]).any(axis=0)]))
        times = np.diff(np.append(first, columns.shape[1]))
        return pa.table({n: pa.array(c) for n, c in zip((*names, "times"), (*columns[:, first], times), strict=True)})

    deleted = blocks.where(F.col("kind") == DELETED).select("block", "tokens", "words").groupBy("block")
    asked = totals.where(F.col("kind") == DELETED).select("block", "part", "answer").groupBy("block")
    seen = deleted.cogroup(asked).applyInArrow(observe, ", ".join(f"{n} bigint" for n in (*names, "times")))
    evidence = stage(seen.groupBy(*names).agg(F.sum("times").alias("times")), "lm_evidence")
    weights = learn_weights(evidence, order, tokens - deleted_tokens, words)

    id_type = blocks.schema["ids"].dataType.elementType
    schema = StructType([StructField(name, id_type), *StructType.fromDDL("held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double").fields])
    fields = schema.names

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        block = left.select(["kind", "lengths", "tokens", "words"]).to_pylist()[0]
        at, counts, contexts = _looked_up(block, right, parts, order, kept_only=False)
        contexts[0] = np.full(len(at), tokens)
        chance = np.log10(mixed(counts, contexts, weights, words)[-1])
        base = np.log10((counts[0] + ADDED) / (tokens + ADDED * (words + 1)))
        lengths = unpack_ints(block["lengths"])
        starts = np.cumsum(lengths) - lengths
        ids = left["ids"].combine_chunks().flatten()
        made = [np.full(len(ids), block["kind"] == HELD_OUT), lengths, np.add.reduceat((counts[0] > 0).astype(np.int64), starts),
                np.full(len(ids), tokens), np.add.reduceat(base, starts), np.add.reduceat(chance, starts)]
        return pa.table([ids, *map(pa.array, made)], names=fields)

    answered = totals.where("block >= 0").select("block", "part", "answer").groupBy("block")
    return blocks.select("block", "kind", "ids", "lengths", "tokens", "words").groupBy("block").cogroup(answered).applyInArrow(score, schema)
