"""Encoding and decoding with a merge-type (BPE) sentencepiece vocabulary.

Method: an agenda of adjacent symbol pairs, ordered by the score of the piece they would form and then by
place. The best pair is merged, its neighbours' pairs are renewed, until no pair forms a piece. No piece
holds a space mark or line end after another character, so a text falls into chunks that never merge with one another; the
chunks of an Arrow batch that are not yet known are merged side by side in numpy, each with its own agenda
(a row of pair ranks whose minimum is next), and long chunks one by one with a heap.

Results for odd input: a NULL or empty text has the begin and end ids only and decodes to ''. Characters
outside the vocabulary become their UTF-8 bytes' pieces. A U+2581 in the text decodes to a space, as in the library.
Repeated rows give repeated results; columns of ``docs`` other than the text are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame

from signal_lake.llm.common import as_column, map_batches, prepare, schema_of

MARK = "▁"
#: Chunks of more characters use the heap; the side-by-side agenda is quadratic in the length.
LONG = 24
#: Chunks a worker remembers.
KNOWN = 600_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Codec:
    """A vocabulary read through the library's public accessors, and the merge rules that follow from it."""

    def __init__(self, path: str):
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.library.get_piece_size()
        ids = range(size)
        self.pieces = [self.library.id_to_piece(i) for i in ids]
        special = [self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i) for i in ids]
        self.begin, self.end, self.unknown = self.library.bos_id(), self.library.eos_id(), self.library.unk_id()
        self.byte_ids = np.array([self.library.piece_to_id(f"<0x{b:02X}>") for b in range(256)], dtype=np.int32)
        self.is_byte = np.zeros(size, dtype=bool)
        self.is_byte[self.byte_ids] = True
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in self.ids):
            raise ValueError("a piece crosses a space or a line end; chunks would not be independent")
        self._cuts()
        #: Rank of a piece: the smaller, the earlier it is merged; pieces of equal score have equal rank.
        scores = {s: r for r, s in enumerate(sorted({self.library.get_score(i) for i in self.ids.values()}, reverse=True))}
        self.rank = {i: scores[self.library.get_score(i)] for i in self.ids.values()}
        self.surface = [b"" if special[i] else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        for value, i in enumerate(self.byte_ids.tolist()):
            self.surface[i] = bytes([value])
        self.surface[self.unknown] = " ⁇ ".encode()
        self._pairs()
        self.known: dict[str, int] = {}
        self._clear()

    def _cuts(self) -> None:
        """Where chunks end: before a mark, around a line end, and after a word before the signs that follow
        a letter or digit in no piece, so that a word is one chunk with and without its comma."""
        after_word = {b for p in self.ids for a, b in zip(p, p[1:], strict=False) if a.isalnum()}
        signs = "".join(re.escape(c) for c in ".,;:!?" if c not in after_word)
        word = f"{MARK}*[^\\W_]+(?=[{signs}])|" if signs else ""
        self.cut = re.compile(f"{word}{MARK}*[^{MARK}\n]+|{MARK}+|\n").findall

    def _pairs(self) -> None:
        """Every pair of pieces that together form a piece, as one sorted key each."""
        keys, merged = [], []
        for piece, i in self.ids.items():
            for cut in range(1, len(piece)):
                left, right = self.ids.get(piece[:cut]), self.ids.get(piece[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    merged.append(i)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.keys = np.array(keys, dtype=np.int64)[order]
        self.merged = np.array(merged, dtype=np.int64)[order]
        self.merged_rank = np.array([self.rank[i] for i in self.merged.tolist()], dtype=np.int64)
        self.pair = dict(zip(self.keys.tolist(), self.merged.tolist(), strict=True))

    def _clear(self) -> None:
        self.known.clear()
        self.flat: list[np.ndarray] = [np.zeros(0, dtype=np.int32)]
        self.starts = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.filled = 0

    # --- merging ------------------------------------------------------------------------------

    def _spell(self, symbols: list[int], chars: str) -> list[int]:
        """Symbols at the end of merging as ids; a negative symbol is a character outside the vocabulary."""
        out: list[int] = []
        for s in symbols:
            if s >= 0:
                out.append(s)
            else:
                out.extend(self.byte_ids[list(chars[-1 - s].encode("utf-8", "surrogatepass"))].tolist())
        return out

    def merge_one(self, chunk: str) -> list[int]:
        """The agenda as a heap of (rank of the piece, place, left, right)."""
        get, pair, rank = self.ids.get, self.pair, self.rank
        symbols = [get(c, -1 - i) for i, c in enumerate(chunk)]
        after = [*range(1, len(symbols)), -1]
        before = [*range(-1, len(symbols) - 1)]
        agenda: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            a, b = symbols[i], symbols[j]
            if a >= 0 and b >= 0 and (m := pair.get(a << 32 | b)) is not None:
                agenda.append((rank[m], i, a, b)) if not started else heapq.heappush(agenda, (rank[m], i, a, b))

        started = False
        for i in range(len(symbols) - 1):
            offer(i, i + 1)
        heapq.heapify(agenda)
        started = True
        gone = -(len(symbols) + 1)
        while agenda:
            _, i, a, b = heapq.heappop(agenda)
            j = after[i]
            if symbols[i] != a or j < 0 or symbols[j] != b:
                continue  # one side was merged meanwhile
            symbols[i], symbols[j] = pair[a << 32 | b], gone
            after[i] = k = after[j]
            if k >= 0:
                before[k] = i
                offer(i, k)
            if before[i] >= 0:
                offer(before[i], i)
        return self._spell([s for s in symbols if s != gone], chunk)

    def _look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and id of the piece each pair forms; the greatest rank where it forms none."""
        keys = np.where((left >= 0) & (right >= 0), left << 32 | right, -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[at] == keys
        return np.where(hit, self.merged_rank[at], NONE), self.merged[at]

    def merge_many(self, chunks: list[str]) -> list[list[int]]:
        """The agendas of chunks of one length, side by side: a row of pair ranks each, least first."""
        n, width = len(chunks), len(chunks[0])
        get = self.ids.get
        symbols = np.array([get(c, -1 - i % width) for i, c in enumerate(chain.from_iterable(chunks))], dtype=np.int64).reshape(n, width)
        size = np.full(n, width)
        if width > 1:
            ranks, ids = self._look_up(symbols[:, :-1], symbols[:, 1:])
            live = np.arange(n)
            while len(live):
                best = np.argmin(ranks[live], axis=1)  # the first of equal ones
                live, best = (x[ranks[live, best] < NONE] for x in (live, best))
                if not len(live):
                    break
                row, ranked, named = symbols[live], ranks[live], ids[live]
                place = np.arange(width)[None, :]
                row[np.arange(len(live)), best] = named[np.arange(len(live)), best]
                shift = np.minimum(place + (place > best[:, None]), width - 1)
                row = np.take_along_axis(row, shift, axis=1)
                pairs = place[:, : width - 1]
                shift = np.minimum(pairs + (pairs > best[:, None]), width - 2)
                ranked, named = np.take_along_axis(ranked, shift, axis=1), np.take_along_axis(named, shift, axis=1)
                size[live] -= 1
                last = size[live]
                for at in (best - 1, best):  # the pairs on both sides of the new symbol
                    ok = np.flatnonzero((at >= 0) & (at < last - 1))
                    ranked[ok, at[ok]], named[ok, at[ok]] = self._look_up(row[ok, at[ok]], row[ok, at[ok] + 1])
                ranked[pairs >= last[:, None] - 1] = NONE
                symbols[live], ranks[live], ids[live] = row, ranked, named
        out = []
        for chunk, row, k, low in zip(chunks, symbols.tolist(), size.tolist(), (symbols.min(axis=1) < 0).tolist(), strict=True):
            out.append(self._spell(row[:k], chunk) if low else row[:k])
        return out

    # --- texts --------------------------------------------------------------------------------

    def chunks(self, text: str) -> list[str]:
        return self.cut(MARK + text.replace(" ", MARK)) if text else []

    def learn(self, chunks: set[str]) -> None:
        """Merge the chunks that are not known and keep their ids in one flat array."""
        by_width: dict[int, list[str]] = {}
        for chunk in chunks:
            by_width.setdefault(len(chunk) if len(chunk) <= LONG else 0, []).append(chunk)
        ids, names = [], []
        for width, some in by_width.items():
            if width:
                for i in range(0, len(some), 8192):
                    ids += self.merge_many(some[i : i + 8192])
            else:
                ids += [self.merge_one(c) for c in some]
            names += some
        sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
        flat = np.fromiter(chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum()))
        base = len(self.sizes)
        self.known.update(zip(names, range(base, base + len(names)), strict=True))
        self.starts = np.concatenate([self.starts, self.filled + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.flat.append(flat)
        self.filled += len(flat)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, without begin and end, and where each text's begin and end."""
        cut = [self.chunks(t or "") for t in texts]
        fresh = set(chain.from_iterable(cut)).difference(self.known)
        if len(self.known) + len(fresh) > KNOWN:
            self._clear()
            fresh = set(chain.from_iterable(cut))
        if fresh:
            self.learn(fresh)
            self.flat = [np.concatenate(self.flat)]
        counts = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        total = int(counts.sum())
        which = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), dtype=np.int64, count=total)
        sizes = self.sizes[which]
        ends = np.cumsum(sizes)
        flat = np.concatenate(self.flat)
        where = np.repeat(self.starts[which] - (ends - sizes), sizes) + np.arange(int(ends[-1]) if total else 0)
        ends = np.concatenate([[0], ends])
        return flat[where], ends[np.concatenate([[0], np.cumsum(counts)])]

    def decode(self, ids: list[int]) -> str:
        """The text of ``ids``: pieces joined, marks to spaces, the first mark dropped, runs of bytes as UTF-8."""
        parts = list(map(self.surface.__getitem__, ids))
        first = next((k for k, i in enumerate(ids) if self.surface[i]), None)
        if first is not None and not self.is_byte[ids[first]] and parts[first][:1] == b" " and ids[first] != self.unknown:
            parts[first] = parts[first][1:]
        inner = ids[1:-1]
        if self.begin not in inner and self.end not in inner:
            try:
                return b"".join(parts).decode()
            except UnicodeDecodeError:
                pass
        return self._decode_runs(ids, parts)

    def _decode_runs(self, ids: list[int], parts: list[bytes]) -> str:
        """Run by run of bytes, as a control piece ends a run: each byte that starts no character is U+FFFD."""
        out, run = [], b""
        for i, part in [*zip(ids, parts, strict=True), (self.begin, b"")]:
            if self.is_byte[i]:
                run += part
                continue
            at = 0
            while at < len(run):
                for width in (1, 2, 3, 4):
                    try:
                        out.append(run[at : at + width].decode())
                        at += width
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    out.append("�")
                    at += 1
            run = b""
            out.append(part.decode())
        return "".join(out)


NONE = np.iinfo(np.int64).max


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process."""
    return Codec(path)


def encode_documents(docs: DataFrame, id_column: Column | str, text_column: Column | str, model: str | None = None, check_rows: int = 1) -> DataFrame:
    """(id, ids, decoded): ids of each text with begin and end, and the text they decode to.

    ``check_rows`` texts of every Arrow batch are also encoded and decoded by the library; a difference ends the job.
    """
    prepare(docs.sparkSession)
    path = model or default_model()

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = codec(path)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        flat, bounds = coder.encode(texts)
        flat = flat.tolist()
        ids = [[coder.begin, *flat[a:b], coder.end] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        decoded = [coder.decode(i) for i in ids]
        for i in range(min(check_rows, len(texts))):
            want = coder.library.encode(texts[i], add_bos=True, add_eos=True)
            if ids[i] != want or decoded[i] != coder.library.decode(want):
                raise ValueError(f"ids or text differ from the library's for row {batch.column(0)[i]}")
        return pa.record_batch([batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string())], ["id", "ids", "decoded"])

    rows = docs.select(as_column(id_column).alias("id"), as_column(text_column).alias("text"))
    return map_batches(rows, encode, schema_of(rows, ["id"], "ids array<int>, decoded string"))


def digests(encoded: DataFrame) -> DataFrame:
    """Counts and digests of ``encode_documents``."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = batch.column(1)
        sizes = lists.value_lengths().to_numpy()
        data = lists.flatten().to_numpy().astype("<u4").tobytes()
        ends = (np.cumsum(sizes) * 4).tolist()
        ids = [hashlib.sha256(data[e - 4 * n : e]).hexdigest() for e, n in zip(ends, sizes.tolist(), strict=True)]
        texts = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in batch.column(2).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(sizes, pa.int64()), pa.array(ids), pa.array(texts)], ["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(encoded, digest, schema_of(encoded, ["id"], "n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
