"""Quality rules by the fertility of public tokenizers.

Method: each text is encoded with two public vocabularies, a BPE of pieces with byte fallback and a byte-level BPE. Three
measures say how well a vocabulary fits a text: characters (in words) per token; the share of tokens that are single
bytes, other than those of ASCII blanks, as no piece covered a character; and the entropy of the text's token
distribution less the entropy that prose of so many tokens has. A text is rejected if a measure leaves the band of its language or,
where none is known, of its script. Before that stand base rules on words and repeated word windows.

Results for odd input: a NULL, empty or blank text has no words and fails the base rules. An unknown or NULL language
takes the band of the script; a text without letters, that of ``other``. Repeated rows are judged alike. Columns
other than id, text and language are not read.
"""

from __future__ import annotations

import base64
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from signal_lake.llm.common import as_column, map_batches, prepare, schema_of, words_of

MIN_WORDS, REPEATED_PERCENT = 50, 50
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Band:
    """Bounds of one vocabulary's measures; entropy is relative to ``expected_entropy``, and has ``SLACK`` below its floor."""

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float


#: Entropy in bits that prose of 2 ** x tokens has in either vocabulary: a parabola up to its top.
CURVE = {"piece": (1.619, 0.854, -0.0347), "byte": (1.677, 0.849, -0.0345)}
#: The entropy of few tokens varies more: a floor is lower by this over the root of their number.
SLACK = 1.6
#: (vocabulary, language or script): bands. The entropy floors lie under all of some ten thousand documents labelled as good;
#: those of scripts are wider, and those of other scripts than Latin only refuse what no prose shows.
BANDS = {
    ("piece", "en"): Band(1.3, 9.0, 0.15, -0.30), ("byte", "en"): Band(1.3, 9.0, 1.0, -0.32),
    ("piece", "de"): Band(1.3, 9.0, 0.15, -0.35), ("byte", "de"): Band(1.3, 9.0, 1.0, -0.36),
    ("piece", "fr"): Band(1.3, 9.0, 0.15, -0.44), ("byte", "fr"): Band(1.3, 9.0, 1.0, -0.46),
    ("piece", "es"): Band(1.3, 9.0, 0.15, -0.48), ("byte", "es"): Band(1.3, 9.0, 1.0, -0.64),
    ("piece", "latin"): Band(1.2, 12.0, 0.25, -0.65), ("byte", "latin"): Band(1.2, 12.0, 1.0, -0.75),
    ("piece", "other"): Band(0.2, 12.0, 0.95, -2.5), ("byte", "other"): Band(0.2, 12.0, 1.0, -2.5),
}
_LATIN = re.compile("[A-Za-zÀ-ÖØ-öø-ɏ]")
_LETTER = re.compile(r"[^\W\d_]")
_ALL_LATIN = re.compile("[\t\n\r\x20-ɏ‐-⁯]*")


def script(text: str) -> str:
    """``latin`` if most letters are, else ``other``."""
    if _ALL_LATIN.fullmatch(text):
        return "latin" if _LATIN.search(text) else "other"
    return "latin" if 2 * len(_LATIN.findall(text)) > len(_LETTER.findall(text)) else "other"


def expected_entropy(vocabulary: str, tokens: int) -> float:
    a, b, c = CURVE[vocabulary]
    x = min(np.log2(max(tokens, 1)), -b / (2 * c))
    return float(a + b * x + c * x * x)


def entropy(ids: np.ndarray) -> float:
    """Bits per token."""
    if not len(ids):
        return 0.0
    share = np.unique(ids, return_counts=True)[1] / len(ids)
    return float(-(share * np.log2(share)).sum())


class Vocabularies:
    def __init__(self, piece_model: str, byte_ranks: str):
        import public_tokenizers
        import sentencepiece
        import tiktoken

        self.pieces = sentencepiece.SentencePieceProcessor(model_file=piece_model)
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in open(byte_ranks, "rb") if line.strip())}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.fallback[[self.pieces.piece_to_id(f"<0x{ord(c):02X}>") for c in BLANKS]] = False

    def encode(self, texts: list[str]) -> dict[str, list[np.ndarray]]:
        return {
            "piece": [np.asarray(i, dtype=np.int32) for i in self.pieces.encode(texts, num_threads=1)] if texts else [],
            "byte": [np.asarray(self.ranks.encode_ordinary(t), dtype=np.int32) for t in texts],
        }


@lru_cache(maxsize=2)
def vocabularies(piece_model: str, byte_ranks: str) -> Vocabularies:
    return Vocabularies(piece_model, byte_ranks)


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words in windows that occur twice or more, each word once."""
    if len(words) <= window:
        return 0
    numbers: dict[bytes, int] = {}
    which = np.array([numbers.setdefault(w, len(numbers)) for w in words], dtype=np.int64)
    key = which[: len(which) - window + 1]
    for k in range(1, window):
        key = key * len(numbers) + which[k : len(which) - window + 1 + k]
        if k < window - 1 or len(numbers) > 1 << 20:
            key = np.unique(key, return_inverse=True)[1]  # small numbers again, so that the next step can't overflow
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(words), dtype=bool)
    for k in range(window):
        covered[k : k + len(twice)] |= twice
    return int(covered.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    if "\n" not in text:
        return 0
    seen: set[str] = set()
    found = 0
    for line in text.split("\n"):
        if line in seen:
            found += 1
        elif line.strip(BLANKS):
            seen.add(line)
    return found


_SCHEMA = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
    "chars_per_piece double, byte_share double, piece_entropy double, chars_per_byte_token double, byte_token_entropy double, broken string"
)


def judge(docs: DataFrame, id_column: str = "doc_id", text_column: Column | str = "text", language_column: Column | str | None = "lang",
          piece_model: str | None = None, byte_ranks: str | None = None, bands: dict[tuple[str, str], Band] = BANDS) -> DataFrame:
    """A row per document: its id, the base measures, the fertility measures, the verdict and the rule that broke it."""
    prepare(docs.sparkSession)
    if piece_model is None or byte_ranks is None:
        import public_tokenizers

        piece_model = piece_model or public_tokenizers.path("piece_bpe_32k.model")
        byte_ranks = byte_ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")

    def measured(text: str, language: str | None, ids: dict[str, np.ndarray], fallback: np.ndarray) -> tuple:
        words = words_of(text)
        n, repeated = len(words), repeated_words(words)
        chars = len(text) - sum(map(text.count, BLANKS))
        failed = n < MIN_WORDS or 100 * repeated > REPEATED_PERCENT * n
        kind = script(text)
        numbers, broken = [], None
        for name, found in ids.items():
            band = bands.get((name, language)) if kind == "latin" else None
            band = band or bands[name, kind]
            per_token, bits = chars / max(1, len(found)), entropy(found)
            share = float(fallback[found].mean()) if name == "piece" and len(found) else 0.0
            numbers += [per_token, share, bits] if name == "piece" else [per_token, bits]
            if not band.least_chars <= per_token <= band.most_chars:
                broken = broken or f"{name}: characters per token"
            elif share > band.most_bytes:
                broken = broken or f"{name}: byte share"
            elif bits - expected_entropy(name, len(found)) < band.least_entropy - SLACK / np.sqrt(max(1, len(found))):
                broken = broken or f"{name}: entropy"
        if failed:
            broken = "words" if n < MIN_WORDS else "repeated words"
        return (n, chars, sum(map(text.count, SYMBOLS)), duplicate_lines(text), repeated, failed, broken is None, *numbers, broken)

    def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
        tools = vocabularies(piece_model, byte_ranks)
        texts = [t or "" for t in batch.column(1).to_pylist()]
        ids = tools.encode(texts)
        rows = [
            measured(text, language, {name: found[i] for name, found in ids.items()}, tools.fallback)
            for i, (text, language) in enumerate(zip(texts, batch.column(2).to_pylist(), strict=True))
        ]
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 5 + [pa.string()]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.record_batch([batch.column(0), *columns], ["id", *(f.split()[0] for f in _SCHEMA.split(", "))])

    language = F.lit(None) if language_column is None else as_column(language_column)
    rows = docs.select(F.col(id_column).alias("id"), as_column(text_column).alias("text"), language.cast("string").alias("language"))
    return map_batches(rows, measure, schema_of(rows, ["id"], _SCHEMA)).withColumnRenamed("id", id_column)
