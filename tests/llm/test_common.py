"""Counting long texts piece by piece."""

from __future__ import annotations

import random

import numpy as np
import pytest

from vigilog.llm import common, language, quality


def texts():
    draw = random.Random(8)
    parts = ["a", "bcd", "é", " ", "  ", "\n", "\t", "(x", "1,2", "word", "word", "...", "ÀB"]
    made = ["".join(draw.choice(parts) for _ in range(draw.randrange(400))) for _ in range(120)]
    return [*made, "", " " * 300, "x" * 300, "x" * 50 + " " + "y" * 200, "same " * 80, " ".join("ab" * draw.randrange(1, 40) for _ in range(30))]


@pytest.mark.parametrize("size", [1, 5, 40, 250])
@pytest.mark.parametrize("measure", [quality.terms, language.ngrams])
def test_pieces_add_up_to_the_whole(monkeypatch, size, measure):
    whole = [measure([t]) for t in texts()]
    monkeypatch.setattr(common, "PIECE_CHARS", size)
    for text, expected in zip(texts(), whole, strict=True):
        assert (common.counts_of([text], measure) == expected).all()
        found = list(common.pieces(text))
        assert sum(sign * len(piece) for piece, sign in found) == len(text)


def test_pieces_are_short(monkeypatch):
    monkeypatch.setattr(common, "PIECE_CHARS", 100)
    found = list(common.pieces("some words of a text " * 500))
    assert max(len(piece) for piece, _ in found) < 130 and len(found) > 150


def test_sparse_counts(spark):
    some = texts()[:40]
    rows = spark.createDataFrame(list(enumerate(some)), "id int, text string").coalesce(1)
    table = common.sparse_counts(rows, "text", quality.terms, ["id"]).toArrow()
    assert (common.dense_counts(table, quality.WIDTH) == np.concatenate([quality.terms([some[i]]) for i in table.column("id").to_pylist()])).all()
