"""Rows that operators must survive."""

from __future__ import annotations

#: Documents with a NULL in each column, repeated rows, ties, odd texts, and columns that operators use themselves.
LONG = "word one two three four. " * 6000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog and runs away again.", "en"),
    (2, None, "en"),
    (3, "", "de"),
    (4, " \t\n ", "fr"),
    (None, "A text without a number.", None),
    (5, "Der schnelle braune Fuchs springt über den faulen Hund.", None),
    (6, "12345 67890 --- ???", "en"),
    (7, LONG, "en"),
    (7, LONG, "en"),
    (8, "same id, first text of two", "en"),
    (8, "same id, second text of two", "en"),
    (9, "日本語のテキスト 🙂 \u0000 ▁▁  <s> </turn>", None),
    (10, "x" * 3000, "en"),
    (11, "The quick brown fox jumps over the lazy dog and runs away again.", "de"),
    (12, "one two", "en"),
    (13, "ONE  TWO", "en"),
]
CLASHING = ["row", "id", "node", "key", "score", "kept", "rank", "held_out", "lang_pred", "bands", "shard", "length", "piece", "link", "content", "_block"]
