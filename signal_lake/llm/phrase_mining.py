"""Phrase collocations: Toivonen's sampling algorithm for contiguous phrases, then exact scores.

Method: a sample of the texts proposes phrases that may be frequent, level by level and under a lowered threshold. A full pass then counts exactly the
proposed phrases and their negative border: every phrase that was not proposed but whose parts were (single words have no parts, so all of them are
counted). A border phrase that turns out frequent is a failure: what extends it was not counted. Failures join the proposed phrases and a further
pass counts what they add, until a pass has none; then every frequent phrase was counted, whatever the sample missed. No pass
counts a phrase twice. Proposed phrases are kept as a bit map of their hashes, of bounded size; a bit that two phrases share
makes a pass count more than it must and changes no result.

How it runs: texts become blocks of word numbers by group and by sample, which all passes read. A block gives each of its different phrases
once, so a frequent phrase is one entry a block, and packed entries are added up part by part of the space of hashes. Phrases go by their words themselves. Scores are whole numbers of up to 38 digits, exact
for counts below 10 ** 16. Parts of phrases are looked up by (part, salt), as a frequent word is part of many phrases; first rows of a
group are cut within salts first.

Results for odd input: a NULL text has no words; a NULL group is ``und``. Repeated rows count as often as they occur. Words hold any character but blanks
and the marks that split pieces. Groups without a phrase that is frequent give no row, and so does an empty table. Other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from signal_lake.llm.common import as_column, lookup_salted, prepare
from signal_lake.llm.token_blocks import Block, joined_hash, pack_ints, pack_words, share_of, unpack_ints, unpack_words, word_hashes
from signal_lake.operators.skew import first_n
from signal_lake.session import stage

UNKNOWN = "und"
LEAST, LONGEST, FIRST = 10, 3, 2000
#: Share of the texts in the sample, and how far the threshold is lowered there.
SAMPLE, LOWERED = 0.25, 0.8
#: Bits a proposed phrase gets in a map, and bounds of a map's size: 128 KB to 32 MB.
BITS_EACH, LEAST_BITS, MOST_BITS = 32, 20, 28
_CHUNK = 16
#: Tokens that a task holds while it makes blocks, and about so many phrases does a task add up at a time.
HELD_TOKENS, PART_KEYS = 1 << 21, 1 << 20
_SPLIT = bytes.maketrans(b"\t.,;:!?\n\x0b\x0c\r", b" " + b"\xff" * 10)


def pieces(text: bytes | None) -> list[bytes]:
    """Words of a text, with an empty one at the end of each piece. Byte 0xff, which UTF-8 never has, marks the ends meanwhile."""
    words = (text or b"").lower().translate(_SPLIT).replace(b"\xff", b" \xff ").split()
    return [b"" if w == b"\xff" else w for w in words] + [b""]


def _blocks(docs: DataFrame, text_column: Column, group_column: Column, block_tokens: int) -> DataFrame:
    """Staged rows (lang, sampled, n_words, tokens, words)."""
    rows = docs.select(F.coalesce(group_column.cast("string"), F.lit(UNKNOWN)).alias("lang"), (F.rand(11) < SAMPLE).alias("sampled"), text_column.cast("binary").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, bool], Block] = {}

        def flush(*keys: tuple[str, bool]) -> pa.RecordBatch:
            made = []
            for key in keys:
                block = held.pop(key)
                made.append((*key, sum(int((p > 0).sum()) for p in block.parts), *block.take()))
            kinds = [pa.string(), pa.bool_(), pa.int64(), pa.binary(), pa.binary()]
            columns = zip(zip(*made, strict=True), kinds, strict=True)
            return pa.record_batch([pa.array(c, k) for c, k in columns], ["lang", "sampled", "n_words", "tokens", "words"])

        size = 0
        for batch in batches:
            for lang, sampled, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = pieces(text)
                if len(words) > 1:
                    held.setdefault((lang, sampled), Block()).add(words)
                    size += len(words)
                if size >= block_tokens:  # the largest block goes, so that blocks of rare groups can grow
                    largest = max(held, key=lambda key: held[key].size)
                    size -= held[largest].size
                    yield flush(largest)
        if held:
            yield flush(*held)

    return stage(rows.mapInArrow(write, "lang string, sampled boolean, n_words bigint, tokens binary, words binary"), "phrase_blocks")


@dataclass(frozen=True)
class Proposed:
    """Bit maps of the proposed phrases by length, from one word on; a missing map holds nothing."""

    maps: tuple[np.ndarray, ...] = ()

    def has(self, length: int, hashes: np.ndarray) -> np.ndarray:
        if length > len(self.maps):
            return np.zeros(len(hashes), dtype=bool)
        bits = self.maps[length - 1]
        at = hashes >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
        return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

    def with_map(self, length: int, bits: np.ndarray) -> Proposed:
        """These and the phrases of ``bits``."""
        maps = list(self.maps)
        if length > len(maps):
            maps.append(bits)
        else:
            maps[length - 1] = maps[length - 1] | bits
        return replace(self, maps=tuple(maps))


def _seed(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode())


def _phrase_hash(lang: str, phrase: str) -> np.ndarray:
    """As in ``_count``: words by their own hash, longer phrases joined from the left."""
    own = word_hashes(phrase.encode().split(b" "), _seed(lang))
    found = own[:1]
    for k in range(1, len(own)):
        found = joined_hash(found, own[k : k + 1])
    return found


def _count(blocks: DataFrame, now: Proposed, before: Proposed, words_too: bool, least: int, longest: int = LONGEST, part_keys: int = PART_KEYS) -> DataFrame:
    """(lang, phrase, length, f): exact counts of the phrases whose parts are all in ``now`` but were not in ``before``, and of all words if asked.

    Phrases with fewer than ``least`` occurrences are counted and left out. A block sends its phrases packed, one row per part of the space
    of hashes; all rows of a phrase meet in its part, where they are added up by the phrase itself.
    """
    spark = blocks.sparkSession
    shared = spark.sparkContext.broadcast((now, before))
    parts = min(max(8, -(-(blocks.agg(F.sum("n_words")).first()[0] or 0) // part_keys)), (1 << 31) - 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = shared.value
        for batch in batches:
            for lang, tokens, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names, at = unpack_words(words), unpack_ints(tokens)
                own, spelled = word_hashes(names, _seed(lang)), np.array(names, dtype=object)
                found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
                if words_too:
                    n = np.bincount(at, minlength=len(names))
                    found.append((spelled[1:], own[1:], n[1:]))
                # Of the phrase that begins at a token: does it lie in a piece, and are all its parts proposed, now and before?
                inside = at > 0
                part_now, part_before = inside & now.has(1, own)[at], inside & before.has(1, own)[at]
                place, hashes = at, own[at]
                for length in range(2, longest + 1):
                    # Its parts are the phrases one word shorter that begin at its token and at the next one.
                    many = len(at) - length + 1
                    if many < 1:
                        break
                    whole_now = part_now[:-1] & part_now[1:]
                    whole_before = part_before[:-1] & part_before[1:]
                    hashes = joined_hash(hashes[:many], own[at[length - 1 :]])
                    new = np.flatnonzero(whole_now & ~whole_before)
                    if len(new):
                        # Number the different phrases from those of one word less, so that no hash decides what is equal.
                        first, past = place[new], at[new + length - 1]
                        key = first * len(names) + past
                        _, one, n = np.unique(key, return_index=True, return_counts=True)
                        phrases = spelled[at[new[one]]]
                        for k in range(1, length):
                            phrases = phrases + b" " + spelled[at[new[one] + k]]
                        found.append((phrases, hashes[new[one]], n))
                    if length < longest:
                        place = np.unique(place[:many] * len(names) + at[length - 1 :], return_inverse=True)[1]
                        part_now, part_before = whole_now & now.has(length, hashes), whole_before & before.has(length, hashes)
                if not found:
                    continue
                phrases, hashed, n = (np.concatenate(x) for x in zip(*found, strict=True))
                place = share_of(hashed, parts)
                order = np.argsort(place, kind="stable")
                phrases, place, n = phrases[order].tolist(), place[order], n[order]
                used = np.unique(place)
                edges = np.searchsorted(place, np.append(used, parts)).tolist()
                cuts = [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]
                yield pa.record_batch(
                    [pa.array(used, pa.int32()), pa.array([lang] * len(used), pa.string()), pa.array([pack_words(phrases[c], b"\n") for c in cuts], pa.binary()),
                     pa.array([pack_ints(n[c]) for c in cuts], pa.binary())],
                    ["part", "lang", "phrases", "counts"],
                )

    def add_up(table: pa.Table) -> pa.Table:
        made = []
        for lang in table["lang"].unique().to_pylist():
            some = table.filter(pc.equal(table["lang"], lang))
            numbers: defaultdict[bytes, int] = defaultdict()
            numbers.default_factory = numbers.__len__
            at, n = [], []
            for phrases, counts in zip(some["phrases"].to_pylist(), some["counts"].to_pylist(), strict=True):
                words = unpack_words(phrases, b"\n")
                at.append(np.fromiter(map(numbers.__getitem__, words), np.int64, len(words)))
                n.append(unpack_ints(counts))
            total = np.zeros(len(numbers), np.int64)
            np.add.at(total, np.concatenate(at), np.concatenate(n))
            often = np.flatnonzero(total >= least)
            phrases = pa.array(np.array(list(numbers), dtype=object)[often], pa.binary()).cast(pa.string())
            length = pc.add(pc.count_substring(phrases, " "), 1)
            made.append(pa.table({"lang": pa.array([lang] * len(often), pa.string()), "phrase": phrases, "length": length.cast(pa.int32()), "f": pa.array(total[often])}))
        return pa.concat_tables(made)

    sent = blocks.select("lang", "tokens", "words").mapInArrow(emit, "part int, lang string, phrases binary, counts binary")
    return sent.groupBy("part").applyInArrow(add_up, "lang string, phrase string, length int, f bigint")


def _bits_for(count: int) -> int:
    return min(max(int(count * BITS_EACH).bit_length(), LEAST_BITS), MOST_BITS)


def _bit_map(phrases: DataFrame, length: int, bits: int) -> np.ndarray:
    """Map of the phrases of one length. It is built in chunks, which Spark joins; at most ``2 ** bits / 8`` bytes reach the driver."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros((1 << bits) // 8, np.uint8)
        for batch in batches:
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                at = int(_phrase_hash(lang, phrase)[0]) >> (64 - bits)
                own[at >> 3] |= 1 << (at & 7)
        chunks = own.reshape(-1, min(len(own), 1 << _CHUNK))
        used = np.flatnonzero(chunks.any(axis=1))
        yield pa.record_batch([pa.array(used, pa.int32()), pa.array([chunks[i].tobytes() for i in used.tolist()], pa.binary())], ["chunk", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        merged = np.bitwise_or.reduce([np.frombuffer(b.as_py(), np.uint8) for b in table["bits"]])
        return pa.table({"chunk": table["chunk"][:1], "bits": pa.array([merged.tobytes()], pa.binary())})

    rows = phrases.where(F.col("length") == length).select("lang", "phrase").mapInArrow(mark, "chunk int, bits binary")
    whole = np.zeros((1 << bits) // 8, np.uint8)
    parts = whole.reshape(-1, min(len(whole), 1 << _CHUNK))
    for row in rows.groupBy("chunk").applyInArrow(merge, "chunk int, bits binary").collect():
        parts[row["chunk"]] = np.frombuffer(row["bits"], np.uint8)
    return whole


def _propose(blocks: DataFrame, least: int, longest: int) -> Proposed:
    """Phrases of the sample at the lowered threshold, level by level; those of the greatest length have no extensions and need no map."""
    sample = blocks.where("sampled")
    lowered = max(1, int(least * SAMPLE * LOWERED))
    proposed = Proposed()
    for length in range(1, longest):
        before = proposed if length > 1 else Proposed()
        counted = _count(sample, before, Proposed(), words_too=length == 1, least=lowered, longest=length)
        likely = stage(counted.select("lang", "phrase", "length"), "proposed")
        proposed = proposed.with_map(length, _bit_map(likely, length, _bits_for(likely.count())))
    return proposed


def _failures(frequent: DataFrame, proposed: Proposed, longest: int) -> DataFrame:
    """Frequent phrases with possible extensions that were not proposed."""
    shared = frequent.sparkSession.sparkContext.broadcast(proposed)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lacking = [
                not shared.value.has(length, _phrase_hash(lang, phrase))[0]
                for lang, phrase, length in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            yield batch.filter(pa.array(lacking, pa.bool_()))

    return frequent.where(F.col("length") < longest).select("lang", "phrase", "length").mapInArrow(keep, "lang string, phrase string, length int")


def frequent_phrases(blocks: DataFrame, least: int = LEAST, longest: int = LONGEST, proposed: Proposed | None = None) -> tuple[DataFrame, list[int]]:
    """(staged rows (lang, phrase, length, f) of all phrases with at least ``least`` occurrences, failures of each pass)."""
    now = _propose(blocks, least, longest) if proposed is None else proposed
    before, found, failed = Proposed(), [], []
    while True:
        counted = _count(blocks, now, before, words_too=not found, least=least, longest=longest)
        found.append(stage(counted, "frequent"))
        failures = stage(_failures(found[-1], now, longest), "failures")
        by_length = {r["length"]: r["n"] for r in failures.groupBy("length").agg(F.count("*").alias("n")).collect()}
        failed.append(sum(by_length.values()))
        if not by_length:
            break
        before = now
        for length in range(1, longest):
            if length in by_length or length > len(now.maps):
                bits = (len(now.maps[length - 1]) * 8).bit_length() - 1 if length <= len(now.maps) else LEAST_BITS
                now = now.with_map(length, _bit_map(failures, length, bits))
    whole = found[0]
    for more in found[1:]:
        whole = whole.union(more)
    return whole, failed


def scored_phrases(frequent: DataFrame) -> DataFrame:
    """(lang, phrase, length, a, cut, l, r, score) of all candidates, those of the lowest-scoring cut."""
    phrases = frequent.where("length > 1").withColumnsRenamed({"f": "a"})
    words = F.split("phrase", " ", -1)
    cut = F.explode(F.sequence(F.lit(1), F.col("length") - 1)).alias("cut")
    rows = phrases.select("lang", "phrase", "length", "a", words.alias("w"), cut)
    rows = rows.select("lang", "phrase", "length", "a", "cut", F.array_join(F.expr("slice(w, 1, cut)"), " ").alias("first"), F.array_join(F.expr("slice(w, cut + 1, length - cut)"), " ").alias("rest"))
    for part, name in (("first", "l"), ("rest", "r")):
        counts = frequent.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
        rows = lookup_salted(rows, counts, ["lang", part], ["phrase", "cut"])
    exact = "(1000000BD * CAST(a AS DECIMAL(16,0)) * CAST(a AS DECIMAL(16,0))) div (CAST(l AS DECIMAL(16,0)) * CAST(r AS DECIMAL(16,0)))"
    rows = rows.withColumn("score", F.expr(exact))
    lowest = F.min(F.struct("score", "cut", "l", "r")).alias("least")
    return rows.groupBy("lang", "phrase", "length", "a").agg(lowest).select("lang", "phrase", "length", "a", "least.cut", "least.l", "least.r", "least.score")


def without_covered(scored: DataFrame) -> DataFrame:
    """Phrases of which no longer candidate holds half the occurrences or more."""
    words = F.split("phrase", " ", -1)
    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), F.col("length") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.col("length") - size + 1), lambda start: F.array_join(F.slice(words, start, size), " ")),
    ))
    longer = scored.where("length > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), F.col("a").alias("held"))
    most = longer.groupBy("lang", "phrase").agg(F.max("held").alias("held"))
    kept = scored.join(most, ["lang", "phrase"], "left")
    return kept.where(F.col("held").isNull() | (100 * F.col("held") < 50 * F.col("a"))).drop("held")


def mine_phrases(
    docs: DataFrame, text_column: Column | str = "text", group_column: Column | str = "lang", least: int = LEAST, first: int = FIRST,
    block_tokens: int = HELD_TOKENS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of each group."""
    spark: SparkSession = docs.sparkSession
    prepare(spark)
    blocks = _blocks(docs, as_column(text_column), as_column(group_column), block_tokens)
    frequent, _ = frequent_phrases(blocks, least)
    scored = stage(scored_phrases(frequent), "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = first_n(without_covered(scored), ["lang"], order, first, first)
    ranked = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    totals = blocks.groupBy("lang").agg(F.sum("n_words").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("bigint").alias("score"))
