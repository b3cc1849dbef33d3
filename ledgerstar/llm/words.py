"""Hashes of words and of word shingles, for whole texts at once."""

from __future__ import annotations

import numpy as np

GRAM = 5
_MIX = np.uint64(0x9E3779B97F4A7C15)

_draw = np.random.default_rng(64)
# Characters beyond ASCII, as ASCII letters, digits and the underscore, make up words.
_IN_WORD = np.array([b >= 128 or chr(b).isalnum() or chr(b) == "_" for b in range(256)])
_BYTE = _draw.integers(0, 1 << 64, 256, dtype=np.uint64)
_POWER = int(_draw.integers(0, 1 << 63)) * 2 + 1
_INVERSE = pow(_POWER, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_STEP = 1 << 16
_UP, _DOWN = _powers(_POWER, _STEP + 1), _powers(_INVERSE, _STEP + 1)


def _edges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end among the bytes of a text."""
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _IN_WORD[raw]
    edge = np.diff(inside)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_count(raw: bytes) -> int:
    return len(_edges(np.frombuffer(raw, np.uint8))[0])


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "replace")


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash of every word of a text, in order and in lower case.

    The hash of a word is a polynomial of its bytes modulo 2**64; sums over a word are
    differences of running sums, which the inverse powers bring to a common start.
    """
    raw = np.frombuffer(lowered(text), np.uint8)
    begins, ends = _edges(raw)
    if not len(begins):
        return np.empty(0, np.uint64)
    if len(raw) <= _STEP:
        up, down = _UP[: len(raw)], _DOWN
    else:
        up, down = _powers(_POWER, len(raw)), _powers(_INVERSE, len(raw) + 1)
    with np.errstate(over="ignore"):
        running = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * up, out=running[1:])
        return mixed((running[ends] - running[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def gram_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the GRAM words from every position on; one hash for fewer words, none for none."""
    if not len(words):
        return np.empty(0, np.uint64)
    span = max(1, len(words) - GRAM + 1)
    code = np.zeros(span, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(min(GRAM, len(words))):
            code = code * _MIX + words[at : at + span] + np.uint64(at + 1)
            code ^= code >> np.uint64(29)
    return mixed(code)
