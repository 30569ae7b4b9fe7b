"""Counts over whole texts, a batch of documents at a time."""

from __future__ import annotations

import numpy as np

from histlake.llm.common import hashed_words, mix, windows

#: Fixed value: the characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
WHITE = b" \t\n\v\f\r"
CONTINUATION = bytes(range(0x80, 0xC0))


def code_points(b: bytes) -> int:
    return len(b) if b.isascii() else len(b.translate(None, CONTINUATION))


def duplicate_lines(text: bytes) -> tuple[int, int]:
    """(lines with a word, those of them equal to an earlier line)."""
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    return len(lines), len(lines) - len(set(lines))


def repeated_words(h: np.ndarray, counts: np.ndarray, size: int = 3) -> np.ndarray:
    """Per text, the words covered by a ``size``-word window that the text
    holds twice or more (the first one included)."""
    key, doc = windows(h, counts, size)
    total = np.zeros(len(counts), np.int64)
    at = np.flatnonzero(doc >= 0)
    if not len(at):
        return total
    with np.errstate(over="ignore"):
        k = mix(key[at] + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(k, kind="stable")
    s = k[order]
    same = s[1:] == s[:-1]
    twice = np.zeros(len(s), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(h), bool)
    start = at[order[twice]]
    for i in range(size):
        covered[start + i] = True
    owner = np.repeat(np.arange(len(counts)), counts)
    return total + np.bincount(owner[covered], minlength=len(counts))


def basic(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words."""
    h, counts = hashed_words(texts)
    n = len(texts)
    lines = [duplicate_lines(t) for t in texts]
    return {
        "n_words": counts,
        "word_chars": np.fromiter((code_points(t.translate(None, WHITE)) for t in texts), np.int64, n),
        "n_symbols": np.fromiter((len(t) - len(t.translate(None, SYMBOLS)) for t in texts), np.int64, n),
        "n_lines": np.fromiter((a for a, _ in lines), np.int64, n),
        "n_dup_lines": np.fromiter((b for _, b in lines), np.int64, n),
        "n_repeat_words": repeated_words(h, counts),
    }
