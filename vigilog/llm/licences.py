"""Licence scans through a positional index of rare tokens.

Templates are passages of licences as words, some of which are mandatory key phrases. Documents
are counted for every word of the templates, and each template is indexed under its few
rarest words that occur at all, the ones of highest inverse document frequency, with their
positions. A text looks up all its words that are in the index; postings that agree on where a
template begins are intersected by that relative position. Where enough rare words agree,
the key phrases are verified in place, word by word, and then the share of all words that fit.

Besides templates, base phrases are found wherever their words stand consecutively.

Nulls: a null text has no words, as an empty one; ids may be null. Very long texts are split into
words piece by piece, one small number per word being held. Ties: of equally rare words the
first in order is indexed; all places found are returned. Repeated rows count one by one, in the
frequencies too. An empty table gives no row. Input columns named like the added ones
are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from vigilog.llm import common

# Base phrases and their labels.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Label, passage in lower case without punctuation, and its mandatory key phrases.
TEMPLATES = (
    ("mit", "released under the mit license", ("the mit license",)),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge", "deal in the software without restriction"),
    ),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("distribute this software for any purpose", "with or without fee")),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("source and binary forms", "following conditions are met"),
    ),
    ("apache-2", "licensed under the apache license version 2 0", ("apache license version 2",)),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("except in compliance with the license",)),
    ("gpl-2", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("gpl-3", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl", "under the terms of the gnu general public license as published by the free software foundation", ("gnu general public license", "free software foundation")),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", ("gnu lesser general public license",)),
    ("agpl", "under the terms of the gnu affero general public license as published by the free software foundation", ("gnu affero general public license",)),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2",)),
    ("cc-by", "licensed under cc by 4 0", ("under cc by 4 0",)),
    ("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    ("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license", ("creative commons attribution noncommercial",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", ("any person or organization obtaining a copy",)),
    ("zlib", "this software is provided as is without any express or implied warranty", ("without any express or implied warranty",)),
)

# Words a template is indexed under, how many of their places must agree, and the least share of words that fit.
RARE_WORDS = 4
AGREEING = 2
LEAST_SHARE = 0.8
# Bytes of a text whose words are listed at once, and words compared by one numpy step.
PIECE_BYTES = 1 << 20
STEP_WORDS = 1 << 20

SEPARATORS = "".join(map(chr, (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))))
# Bytes of other characters than ASCII are parts of words like the letters are.
TO_WORDS = bytes.maketrans((SEPARATORS + "ABCDEFGHIJKLMNOPQRSTUVWXYZ").encode(), b" " * len(SEPARATORS) + b"abcdefghijklmnopqrstuvwxyz")

MATCHES = ArrayType(
    StructType(
        [
            StructField("kind", StringType(), False),
            StructField("label", StringType(), False),
            StructField("start", LongType(), False),
            StructField("end", LongType(), False),
            StructField("share", DoubleType(), False),
        ]
    ),
    False,
)
COLUMNS = StructType([StructField("n_words", LongType(), False), StructField("matches", MATCHES, False)])
ARROW = pa.list_(pa.struct([pa.field("kind", pa.string(), False), pa.field("label", pa.string(), False), pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False), pa.field("share", pa.float64(), False)]))


def mandatory(passage: str, keys: tuple[str, ...]) -> list[int]:
    """Positions of a passage's words that lie in its key phrases."""
    words, found = passage.split(), set()
    for key in keys:
        phrase = key.split()
        start = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        found.update(range(start, start + len(phrase)))
    return sorted(found)


def vocabulary(templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> list[str]:
    return sorted({w for _, passage, _ in templates for w in passage.split()} | {w for phrase, _ in phrases for w in phrase.split()})


def word_numbers(text: bytes, numbers: dict[bytes, int]) -> np.ndarray:
    """The number of every word of a text, -1 for words without one."""
    flat = text.translate(TO_WORDS)
    parts, start = [np.zeros(0, dtype=np.int32)], 0
    while start < len(flat):
        cut = flat.find(b" ", start + PIECE_BYTES) if len(flat) - start > PIECE_BYTES else -1
        cut = len(flat) if cut < 0 else cut
        words = flat[start:cut].split()
        parts.append(np.fromiter((numbers.get(w, -1) for w in words), dtype=np.int32, count=len(words)))
        start = cut
    return np.concatenate(parts)


@dataclass(frozen=True)
class Index:
    """Templates with the words they are looked up by; ``frequency`` is per word of ``vocabulary``."""

    templates: tuple
    phrases: tuple
    frequency: dict[str, int]

    @cached_property
    def numbers(self) -> dict[bytes, int]:
        return {w.encode(): i for i, w in enumerate(vocabulary(self.templates, self.phrases))}

    @cached_property
    def passages(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Word numbers of each template, and its mandatory positions."""
        return [(self._coded(passage), np.array(mandatory(passage, keys))) for _, passage, keys in self.templates]

    @cached_property
    def coded_phrases(self) -> list[np.ndarray]:
        return [self._coded(phrase) for phrase, _ in self.phrases]

    def rare(self, place: int) -> list[str]:
        """The rarest words of a template among those the corpus holds."""
        words = {w for w in self.templates[place][1].split() if self.frequency.get(w, 0) > 0}
        return sorted(words, key=lambda w: (self.frequency[w], w))[:RARE_WORDS]

    @cached_property
    def postings(self) -> dict[int, list[tuple[int, int]]]:
        """(template, position) per number of a rare word."""
        found: dict[int, list[tuple[int, int]]] = {}
        for place, (_, passage, _) in enumerate(self.templates):
            rare = set(self.rare(place))
            for position, word in enumerate(passage.split()):
                if word in rare:
                    found.setdefault(self.numbers[word.encode()], []).append((place, position))
        return found

    @cached_property
    def needed(self) -> list[int]:
        """Postings that must agree, per template: fewer only where it has fewer."""
        counts = [0] * len(self.templates)
        for listed in self.postings.values():
            for place, _ in listed:
                counts[place] += 1
        return [max(1, min(AGREEING, n)) for n in counts]

    def _coded(self, words: str) -> np.ndarray:
        return np.array([self.numbers[w.encode()] for w in words.split()], dtype=np.int32)


def candidates(words: np.ndarray, index: Index) -> Iterator[tuple[int, np.ndarray]]:
    """(template, starts) where enough postings of rare words agree on the start."""
    starts: dict[int, list[np.ndarray]] = {}
    for number, listed in index.postings.items():
        places = np.flatnonzero(words == number)
        if len(places):
            for template, position in listed:
                starts.setdefault(template, []).append(places - position)
    for template in sorted(starts):
        if len(starts[template]) >= index.needed[template]:
            start, votes = np.unique(np.concatenate(starts[template]), return_counts=True)
            yield template, start[votes >= index.needed[template]]


def find(words: np.ndarray, index: Index) -> list[dict]:
    """Base phrases, then verified templates, each by its place in the list and then by start."""
    found = []
    for phrase, (_, label) in zip(index.coded_phrases, index.phrases, strict=True):
        size = len(phrase)
        hit = np.flatnonzero(words[: max(0, len(words) - size + 1)] == phrase[0])
        for k in range(1, size):
            hit = hit[words[hit + k] == phrase[k]]
        found += [{"kind": "base", "label": label, "start": s, "end": s + size, "share": 1.0} for s in hit.tolist()]
    for template, starts in candidates(words, index):
        passage, must = index.passages[template]
        size = len(passage)
        for some in np.array_split(starts, len(starts) * size // STEP_WORDS + 1):
            places = some[:, None] + np.arange(size)
            inside = (places >= 0) & (places < len(words))
            same = inside & (words[np.clip(places, 0, len(words) - 1)] == passage)
            fits = same.sum(axis=1)
            good = same[:, must].all(axis=1) & (fits >= LEAST_SHARE * size)
            label = index.templates[template][0]
            found += [{"kind": "template", "label": label, "start": s, "end": s + size, "share": n / size} for s, n in zip(some[good].tolist(), fits[good].tolist(), strict=True)]
    return found


def _texts(docs: DataFrame, text: str) -> Column:
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


def fit(docs: DataFrame, text: str = "text", templates: tuple = TEMPLATES, phrases: tuple = PHRASES) -> Index:
    """Count, over all documents, in how many each word of the templates occurs.

    A task hands on at most one row per word of the templates.
    """
    common.ship_code(docs.sparkSession)
    words = vocabulary(templates, phrases)
    numbers = {w.encode(): i for i, w in enumerate(words)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(words), dtype=np.int64)
        for batch in batches:
            for body in batch.column(0):
                own = word_numbers(body.as_py(), numbers)
                counts[np.unique(own[own >= 0])] += 1
        hit = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(hit.astype(np.int32)), pa.array(counts[hit])], names=["word", "n"])

    counted = docs.select(_texts(docs, text).alias("body")).mapInArrow(run, "word int, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return Index(templates, phrases, {words[place]: n for place, n in counted.collect()})


def scan(docs: DataFrame, index: Index, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``n_words`` and ``matches``: (kind, label, start, end, share), places in words from 0.

    Base phrases come first, by phrase and start, then templates, by template and start.
    """

    def compute(values: dict[str, list]) -> list[pa.Array]:
        counts, matches = [], []
        for body in values["__body"]:
            words = word_numbers(body, index.numbers)
            counts.append(len(words))
            matches.append(find(words, index))
        return [pa.array(counts, pa.int64()), pa.array(matches, ARROW)]

    names = docs.columns if keep is None else keep
    return common.add_columns(docs.withColumn("__body", _texts(docs, text)), ["__body"], COLUMNS, compute, names)


def _labels(matches: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")


def summary(found: DataFrame, *carried: str) -> DataFrame:
    """Counts, places and labels of each row of ``scan``; the score is the best share of a match."""
    base = F.filter("matches", lambda m: m["kind"] == "base")
    starts = F.transform(base, lambda m: m["start"])
    return found.select(
        *carried,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"),
        _labels(F.col("matches")).alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["share"])), F.lit(0.0)).alias("score"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return summary(scan(docs, fit(docs), keep=["doc_id"]), "doc_id")


def oracle() -> str:
    """The same search in SQL, over a table of all words."""
    rows = [
        (place, label, position, word, position in must)
        for place, (label, passage, keys) in enumerate(TEMPLATES)
        for must in [mandatory(passage, keys)]
        for position, word in enumerate(passage.split())
    ]
    templates = ", ".join(f"({place}, '{label}', {position}, '{word}', {must})" for place, label, position, word, must in rows)
    base = " UNION ALL ".join(
        f"SELECT a.r, '{label}' AS label, a.i FROM known a {' '.join(f'JOIN known w{k} ON w{k}.r = a.r AND w{k}.i = a.i + {k}' for k in range(1, len(words)))} "
        f"WHERE a.word = '{words[0]}' {' '.join(f"AND w{k}.word = '{words[k]}'" for k in range(1, len(words)))}"
        for phrase, label in PHRASES
        for words in [phrase.split()]
    )
    listed = ", ".join(f"'{w}'" for w in vocabulary())
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
known AS MATERIALIZED (SELECT r, i, word FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM texts) WHERE word IN ({listed})),
templates(t, label, q, word, must) AS (VALUES {templates}),
sizes AS (SELECT t, count(*) AS size, count(*) FILTER (WHERE must) AS musts FROM templates GROUP BY t),
frequency AS (SELECT word, count(DISTINCT r) AS df FROM known GROUP BY word),
rare AS (
  SELECT t, word FROM (SELECT t, word, row_number() OVER (PARTITION BY t ORDER BY df, word) AS place
    FROM (SELECT DISTINCT t, word FROM templates) JOIN frequency USING (word)) WHERE place <= {RARE_WORDS}),
postings AS (SELECT t, q, word FROM templates JOIN rare USING (t, word)),
needed AS (SELECT t, least({AGREEING}, count(*)) AS votes FROM postings GROUP BY t),
starts AS (
  SELECT r, t, i - q AS s FROM known JOIN postings USING (word) GROUP BY r, t, i - q
  HAVING count(*) >= (SELECT votes FROM needed WHERE needed.t = postings.t)),
verified AS (
  SELECT r, t, s, any_value(label) AS label, count(*) AS fits, count(*) FILTER (WHERE must) AS musts
  FROM starts JOIN templates USING (t) JOIN known USING (r, word) WHERE known.i = s + q GROUP BY r, t, s),
good AS (SELECT r, label, fits / size AS share FROM verified JOIN sizes USING (t) WHERE verified.musts = sizes.musts AND fits >= CAST({LEAST_SHARE} AS DOUBLE) * size),
base AS ({base}),
based AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY r),
every AS (SELECT r, label, share FROM good UNION ALL SELECT r, label, 1.0 FROM base),
labelled AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score FROM every GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM texts LEFT JOIN based USING (r) LEFT JOIN labelled USING (r)"""
