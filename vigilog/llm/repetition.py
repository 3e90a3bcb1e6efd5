"""Quality rules on repetition: characters covered by repeated n-grams and lines.

Words of a text become numbers, and every n-gram of several lengths a 64-bit rolling hash
that grows by one word per length. Characters in repeated n-grams are those of words that lie
in an n-gram seen earlier in the text, each counted once.

Nulls: a null text is empty; an empty text has no word and fails for that. Very long texts are measured whole, one at a
time. Ties: of equally frequent n-grams the longest counts. Repeated rows get equal values.
An empty table gives no row. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from vigilog.llm import common

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
BASE_WINDOW = 3
LEAST_WORDS = 50
BASE = np.uint64(0x9E3779B97F4A7C15)

# Largest accepted share of word characters: in the most frequent n-gram of each short
# length, in repeated n-grams of each longer length, and in repeated lines; then the largest
# accepted share of repeated lines and of symbols per word.
# They leave room for one repeated line in a short text.
TOP_SHARE = {2: 0.20, 3: 0.18, 4: 0.16}
REPEATED_SHARE = {5: 0.25, 6: 0.24, 7: 0.23, 8: 0.22, 9: 0.21, 10: 0.20}
LINE_CHAR_SHARE = 0.25
LINE_SHARE = 0.40
SYMBOL_SHARE = 0.10

LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FLAGS = ("base_failed", "kept")
SHARES = ("symbol_share", "dup_line_share", "dup_line_char_share", *(f"top_{n}_share" for n in TOP_SHARE), *(f"dup_{n}_share" for n in REPEATED_SHARE))
COLUMNS = StructType(
    [
        *(StructField(n, LongType(), False) for n in LONGS),
        *(StructField(n, BooleanType(), False) for n in FLAGS),
        *(StructField(n, DoubleType(), False) for n in SHARES),
    ]
)


def spread(values: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mix of small numbers."""
    x = (values.astype(np.uint64) + np.uint64(1)) * BASE
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def has_repeats(values: np.ndarray) -> bool:
    ordered = np.sort(values)
    return bool((ordered[1:] == ordered[:-1]).any())


def covered(starts: np.ndarray, length: int, words: int) -> np.ndarray:
    """Which words lie in a window of ``length`` words that begins at a marked place."""
    edge = np.zeros(words + 1, dtype=np.int64)
    edge[: len(starts)] += starts
    edge[length : length + len(starts)] -= starts
    return np.cumsum(edge)[:words] > 0


def repeated_words(ids: np.ndarray, distinct: int) -> int:
    """Words in a window of BASE_WINDOW words found at least twice, exactly: windows are
    numbered pair by pair, so no hash is involved."""
    if len(ids) < BASE_WINDOW:
        return 0
    windows, kinds = ids.astype(np.int64), distinct
    for k in range(1, BASE_WINDOW):
        windows = windows[:-1] * distinct + ids[k:]
        if kinds * distinct > 1 << 40:
            values, windows = np.unique(windows, return_inverse=True)
            kinds = len(values)
        else:
            kinds *= distinct
    if not has_repeats(windows):
        return 0
    _, place, times = np.unique(windows, return_inverse=True, return_counts=True)
    return int(covered((times[place] > 1).astype(np.int64), BASE_WINDOW, len(ids)).sum())


def measure(text: str) -> list:
    """The values of COLUMNS for one whole text."""
    words = WORD.findall(text)
    count = len(words)
    symbols = sum(map(text.count, SYMBOLS))
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=count)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=count)
    chars = int(sizes.sum())

    lines, duplicates, line_chars, all_lines = set(), 0, 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            all_lines += 1
            if line in lines:
                duplicates += 1
                line_chars += sum(map(len, WORD.findall(line)))
            lines.add(line)

    repeats = repeated_words(ids, len(seen))
    shares = [symbols / max(count, 1), duplicates / max(all_lines, 1), line_chars / max(chars, 1)]
    ngrams = dict.fromkeys([*TOP_SHARE, *REPEATED_SHARE], 0.0)
    values = spread(ids)
    rolling = values
    for length in ngrams:
        rolling = rolling[:-1] * BASE + values[length - 1 :]
        # Where no n-gram repeats, no longer one does, and the rest stays 0.
        if not has_repeats(rolling):
            break
        _, first, place, times = np.unique(rolling, return_index=True, return_inverse=True, return_counts=True)
        if length in TOP_SHARE:
            # The most frequent n-gram, the longest of ties; one seen once covers nothing.
            most = times.max()
            ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
            width = (ends[first + length] - ends[first])[times == most].max()
            ngrams[length] = min(1.0, float(most * width / chars))
        else:
            again = np.ones(len(rolling), dtype=np.int64)
            again[first] = 0
            ngrams[length] = float(sizes[covered(again, length, count)].sum() / chars)
    shares += ngrams.values()

    failed = count < LEAST_WORDS or 100 * repeats > 50 * count
    limits = [SYMBOL_SHARE, LINE_SHARE, LINE_CHAR_SHARE, *TOP_SHARE.values(), *REPEATED_SHARE.values()]
    kept = not failed and all(share <= limit for share, limit in zip(shares, limits, strict=True))
    return [count, chars, symbols, duplicates, repeats, failed, kept, *shares]


def judge(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add the counts, shares and verdicts of COLUMNS to every row.

    A null or empty text has no words: every count and share is 0, and it fails for having
    too few words. Rows are judged alone, so repeated rows get equal values. Input columns
    named like the added ones are replaced.
    """

    def compute(values: dict[str, list]) -> list[pa.Array]:
        columns = list(zip(*(measure(t or "") for t in values[text]), strict=True)) or [()] * len(COLUMNS)
        types = [pa.int64()] * len(LONGS) + [pa.bool_()] * len(FLAGS) + [pa.float64()] * len(SHARES)
        return [pa.array(list(c), kind) for c, kind in zip(columns, types, strict=True)]

    return common.add_columns(docs, [text], COLUMNS, compute, keep)


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return judge(docs, keep=["doc_id"])


def oracle() -> str:
    """The same counts, shares and verdicts in SQL, with n-grams as hashed lists of words."""
    top = ", ".join(map(str, TOP_SHARE))
    again = ", ".join(map(str, REPEATED_SHARE))
    shares = [
        "n_symbols / greatest(n_words, 1) AS symbol_share",
        "n_dup_lines / greatest(n_lines, 1) AS dup_line_share",
        "dup_line_chars / greatest(word_chars, 1) AS dup_line_char_share",
        *(f"CASE WHEN top_{n} > word_chars THEN 1 ELSE coalesce(top_{n} / word_chars, 0) END AS top_{n}_share" for n in TOP_SHARE),
        *(f"coalesce(dup_{n} / word_chars, 0) AS dup_{n}_share" for n in REPEATED_SHARE),
    ]
    limits = dict(zip(SHARES, [SYMBOL_SHARE, LINE_SHARE, LINE_CHAR_SHARE, *TOP_SHARE.values(), *REPEATED_SHARE.values()], strict=True))
    fits = " AND ".join(f"{name} <= CAST({limit!r} AS DOUBLE)" for name, limit in limits.items())
    per_text = [
        *(f"max(CASE WHEN n = {n} THEN chars END) AS top_{n}" for n in TOP_SHARE),
        *(f"max(CASE WHEN n = {n} THEN chars END) AS dup_{n}" for n in REPEATED_SHARE),
    ]
    word = r"[^ \t-\r]+"
    longest = max(REPEATED_SHARE)
    following = ", ".join(
        [*(f"lead(h0, {k}) OVER own AS h{k}" for k in range(1, longest)), *(f"sum(c) OVER (own ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) AS c{n}" for n in range(2, longest + 1))]
    )
    grams = " UNION ALL ".join(
        f"SELECT r, {n} AS n, i, hash({', '.join(f'h{k}' for k in range(n))}) AS g, c{n} AS width FROM following WHERE h{n - 1} IS NOT NULL" for n in range(2, longest + 1)
    )
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
listed AS (SELECT r, body, regexp_extract_all(body, '{word}') AS w FROM texts),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM listed),
placed AS (SELECT r, i, hash(word) AS h0, length(word) AS c FROM words),
following AS (SELECT *, {following} FROM placed WINDOW own AS (PARTITION BY r ORDER BY i)),
grams AS ({grams}),
ranked AS (
  SELECT r, n, i, width, count(*) OVER same AS times, row_number() OVER (same ORDER BY i) AS place FROM grams WINDOW same AS (PARTITION BY r, n, g)),
tops AS (SELECT r, n, max(times * width) AS chars FROM (SELECT *, max(times) OVER (PARTITION BY r, n) AS most FROM ranked WHERE n IN ({top}))
  WHERE times = most AND most > 1 GROUP BY r, n),
hit AS (SELECT DISTINCT r, n, i + k AS i FROM ranked CROSS JOIN range(0, {max(REPEATED_SHARE)}) AS steps(k) WHERE k < n AND n IN ({again}) AND place > 1),
dups AS (SELECT r, n, sum(length(word)) AS chars FROM hit JOIN words USING (r, i) GROUP BY r, n),
shares AS (SELECT r, {", ".join(per_text)} FROM (SELECT * FROM tops UNION ALL SELECT * FROM dups) GROUP BY r),
repeats AS (
  SELECT r, count(DISTINCT i + k) AS n FROM ranked CROSS JOIN range(0, {BASE_WINDOW}) AS steps(k) WHERE n = {BASE_WINDOW} AND times > 1 GROUP BY r),
lines AS (
  SELECT r, line, row_number() OVER (PARTITION BY r, line) AS place FROM (SELECT r, unnest(string_split(body, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '{word}')),
lined AS (
  SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE place > 1) AS n_dup_lines,
    coalesce(sum(length(regexp_replace(line, '[ \\t-\\r]', '', 'g'))) FILTER (WHERE place > 1), 0) AS dup_line_chars
  FROM lines GROUP BY r),
counted AS (
  SELECT r, doc_id, len(w) AS n_words, length(regexp_replace(t.body, '[ \\t-\\r]', '', 'g')) AS word_chars,
    length(regexp_replace(t.body, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeats.n, 0) AS n_repeat_words,
    coalesce(n_lines, 0) AS n_lines, coalesce(dup_line_chars, 0) AS dup_line_chars, shares.* EXCLUDE (r)
  FROM texts t JOIN listed USING (r) LEFT JOIN lined USING (r) LEFT JOIN repeats USING (r) LEFT JOIN shares USING (r)),
rated AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed, {", ".join(shares)} FROM counted)
SELECT doc_id, {", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in LONGS)}, base_failed, NOT base_failed AND {fits} AS kept,
  {", ".join(f"CAST({n} AS DOUBLE) AS {n}" for n in SHARES)}
FROM rated"""
