"""Documents with every awkward case, and columns whose names clash with added ones."""

from __future__ import annotations

CLASHING = ("score", "kept", "ids", "spans", "shard", "page", "row", "bits", "bytes", "label", "term", "lang_pred", "n_tokens", "base", "task", "bucket", "fingerprint_bits")
LONG = ("Word%d of a very long text, at last. " * 1) % 7
TEXTS = [
    (1, "The first text of the table, with some words in it."),
    (1, "The first text of the table, with some words in it."),
    (2, ""),
    (3, None),
    (None, "A text without any id; it counts like the others do."),
    (None, None),
    (4, " \n\t \r "),
    (5, "".join(f"Word{i} of a very long text, at last. " for i in range(20_000))),
    (6, "...!!! 12345 ???"),
    (7, "é😀中 ▁ <s>  x"),
    (8, "The first text of the table, with some words in it."),
]


def frame(spark, texts=TEXTS):
    rows = [(i, t, "en" if i is None or i % 2 else None, None if i == 1 else "src0", None, *["x"] * len(CLASHING)) for i, t in texts]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame(rows, schema)


def texts_of(spark, sf_dir):
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
