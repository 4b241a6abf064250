"""Words as numbers, in compact blocks: what the passes over a corpus read instead of its texts.

A block holds the words of some texts once, and the texts as a row of word numbers. Number 0 is a mark between texts (or pieces of
texts), with the empty word. Blocks are bounded by a number of tokens, except that a text is never cut.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import xxhash
import zstandard

BLOCK_TOKENS = 1 << 19
_compress = zstandard.ZstdCompressor(level=1).compress
_decompress = zstandard.ZstdDecompressor().decompress
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], dtype=np.uint64)


class Block:
    """Collects texts, each as a list of words, until it is taken."""

    def __init__(self) -> None:
        self._clear()

    def _clear(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[b""]  # number 0
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.size += len(words)

    def take(self) -> tuple[bytes, bytes]:
        """(packed numbers, packed words), and begin anew."""
        tokens = np.concatenate(self.parts) if self.parts else np.zeros(0, np.int32)
        packed = pack_ints(tokens), pack_words(list(self.numbers))
        self._clear()
        return packed


def pack_ints(values: np.ndarray) -> bytes:
    """Whole numbers from 0, by byte planes, so that the zeros of small ones stand together."""
    width = np.min_scalar_type(int(values.max()) if len(values) else 0).itemsize
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T
    return bytes([width]) + _compress(planes.tobytes())


def unpack_ints(data: bytes) -> np.ndarray:
    width = data[0]
    planes = np.frombuffer(_decompress(data[1:]), np.uint8).reshape(width, -1)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(np.int64)


def pack_words(words: list[bytes], between: bytes = b" ") -> bytes:
    """Words, or phrases, in order; none holds ``between``."""
    return _compress(between.join(words))


def unpack_words(data: bytes, between: bytes = b" ") -> list[bytes]:
    return _decompress(data).split(between)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Rising 64-bit keys, as differences."""
    return pack_ints(np.diff(keys, prepend=np.uint64(0)).astype(np.uint64))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(data).astype(np.uint64), dtype=np.uint64)


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in words), np.uint64, len(words))


def joined_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a run of words from that of its beginning and that of its last word."""
    with np.errstate(over="ignore"):
        mixed = (context + _FACTORS[1]) * _FACTORS[0] + word
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _FACTORS[2]
        mixed = (mixed ^ (mixed >> np.uint64(29))) * _FACTORS[0]
    return mixed ^ (mixed >> np.uint64(32))


def share_of(hashes: np.ndarray, parts: int) -> np.ndarray:
    """Part of each hash out of fewer than 2 ** 31; it does not fall while hashes rise."""
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
