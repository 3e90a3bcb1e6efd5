"""Hashed n-gram counts of whole texts, computed block by block in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

# Odd multipliers that mix the places of an n-gram.
MIX = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)


@lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Lower-case code point of every letter, 0 for every other code point."""
    size = 0x110000
    table = np.zeros(size, dtype=np.uint32)
    for code in range(size):
        char = chr(code)
        if char.isalpha():
            lower = char.lower()
            table[code] = ord(lower) if len(lower) == 1 else code
    return table


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts, each followed by a line end, and the text index of each."""
    codes = np.frombuffer("".join(t + "\n" for t in texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), [len(t) + 1 for t in texts])
    return codes, owner


def _hash(grams: list[np.ndarray], width: int) -> np.ndarray:
    mixed = np.zeros(len(grams[0]), dtype=np.uint32)
    for place, values in enumerate(grams):
        mixed = (mixed ^ (values * MIX[place])) * MIX[4]
        mixed ^= mixed >> np.uint32(15)
    return (mixed % np.uint32(width)).astype(np.int64)


def counts(owner: np.ndarray, buckets: np.ndarray, texts: int, width: int) -> np.ndarray:
    return np.bincount(owner * width + buckets, minlength=texts * width).reshape(texts, width)


def letter_ngrams(texts: list[str], width: int) -> np.ndarray:
    """Counts of hashed letter bigrams and trigrams within words, one row per text.

    Letters are lower-cased one by one; a run of other characters is one word boundary,
    which takes part in an n-gram only at its ends.
    """
    codes, owner = code_points(texts)
    letters = letter_table()[codes]
    inner = np.empty(len(letters), dtype=bool)
    inner[0] = True
    inner[1:] = (letters[1:] != 0) | (letters[:-1] != 0)
    letters, owner = letters[inner], owner[inner]
    letters = np.concatenate([np.zeros(1, np.uint32), letters, np.zeros(1, np.uint32)])
    owner = np.concatenate([owner[:1], owner, owner[-1:]])
    a, b, c = letters[:-2], letters[1:-1], letters[2:]
    middle = b != 0
    pair, triple = middle, middle & ((a != 0) | (c != 0))
    place = owner[1:-1]
    # Bigram: the middle letter and what follows it, so its owner is the middle letter's.
    first = _hash([b[pair], c[pair]], width)
    second = _hash([a[triple], b[triple], c[triple]], width)
    return counts(np.concatenate([place[pair], place[triple]]), np.concatenate([first, second]), len(texts), width)


def weighted(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit-length rows of damped counts times ``idf``; a row of zeros stays zero."""
    rows = np.log1p(tf.astype(np.float32)) * idf
    norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
    return rows / np.where(norms > 0, norms, 1.0)[:, None]


def inverse_frequency(frequency: np.ndarray, texts: int) -> np.ndarray:
    return np.log((1.0 + texts) / (1.0 + frequency)).astype(np.float32) + np.float32(1.0)
