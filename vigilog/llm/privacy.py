"""Sanitising personal data with what the corpus tells about it.

Base spans follow fixed patterns; their values are the protected entities. A term discloses an
entity as far as the corpus ties it to it. An entity c has the information -log p(c), and seeing
a term t tells log p(c|t) / p(c) of it, their pointwise mutual information; what t leaves
open is the difference, -log p(c|t). A term's disclosure is p(c|t) for the entity it leaves
least open of: 1 if nothing is left, 1/2 if one bit is. It doesn't depend on how large the corpus
is, nor on how rare the entity. Terms of REMOVE and more are removed, those of GENERALISE and
more become their kind, wherever they occur; base spans become the name of theirs.

p(c|t) is Wilson's lower bound of the share of t's texts that hold c, anywhere in them, from as
many observations as the entity has different surroundings in these texts; copies of one text prove no
more than the text. So a plain term must meet an entity in three surroundings or more. A
term written like a name or a number within NEAR words of the entity counts as seen in NAMED
further surroundings: once is enough for it if no other text has the term. Surroundings are
told apart by their hash modulo 63, so there are at least as many as counted. All counts
cover all texts.

How pairs are found: an entity of fewer than SUPPORT surroundings can only be disclosed by the
few terms near it, so only those are paired with it. The others are paired with the
terms of their texts, entities that stand in the same texts as one, and without the most frequent
terms, which more texts hold than any entity could explain.

Terms are runs of three or more letters and digits, and capitalised words of one or two letters.

Nulls: a null text is empty. Empty texts have no span. Very long texts are read whole, one at a
time. Ties: all terms that reach a threshold count, and of overlapping base spans the first is
replaced. Repeated rows are texts in every count, with one surrounding. An empty table gives
no row. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from vigilog.llm import common
from vigilog.operators.joins import spread_lookup
from vigilog.sources.lake import materialise, scratch_path, scratch_scope

# The base patterns, and the digits or parts they must have.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
DIGITS = re.compile(r"[0-9]")
UPPER = "".join(c for c in map(chr, range(0x10000)) if c.isupper() and c.isalpha())
WORD = re.compile(rf"[^\W_]{{3,}}|(?<![^\W_])[{UPPER}][^\W\d_]?(?![^\W_])")
# Words that tell surroundings apart; numbers and initials, which differ in a form letter, don't.
PLAIN = re.compile(r"[^\W\d_]{3,}")
TERM = "term"

# Words on each side that tell surroundings apart, and those a name or number is looked for in.
WINDOW, NEAR = 6, 4
NAMED = 3
# Normal quantile of the one-sided lower bound, 95 %.
QUANTILE = 1.645
GENERALISE, REMOVE = 0.50, 0.80
# The fewest surroundings from which the bound of a term found nowhere else reaches GENERALISE.
SUPPORT = 3
MARKS = 63
# Terms or pairs a task counts before it hands its counts on.
HELD_TERMS = 200_000
# The most frequent terms told to the tasks, to leave out those that can disclose nothing.
COMMON_TERMS = 20_000
# Disclosing terms up to this many characters in all are sent to every task; beyond, they
# are joined to the words of the texts.
SENT_CHARS = 8_000_000

COLUMNS = StructType(
    [
        StructField("spans", ArrayType(StructType([StructField("kind", StringType(), False), StructField("start", LongType(), False), StructField("end", LongType(), False)]), False), False),
        StructField("sanitised", StringType(), False),
    ]
)


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (2 if place % 2 else 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _good(kind: str, found: str) -> bool:
    if kind == "email":
        return True
    if kind == "ip":
        return all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in found.split("."))
    digits = "".join(DIGITS.findall(found))
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """As EMAIL finds them, looking only around each at sign."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and (text[start - 1] in "._%+-" or (text[start - 1].isascii() and text[start - 1].isalnum())):
            start -= 1
        match = EMAIL.match(text, start) if start < at else None
        if match:
            yield match.span()
            last = match.end()
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by kind as listed, then start."""
    spans = [("email", *span) for span in _emails(text)] if "@" in text else []
    if DIGITS.search(text):
        patterns = [("ip", IP), ("card", CARD)] + ([("phone", PHONE)] if "+" in text else [])
        for kind, pattern in patterns:
            spans += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if _good(kind, m[0])]
    return spans


def _entity(kind: str, found: str) -> str:
    """One name for all spellings of a value."""
    value = found.lower() if kind in ("email", "ip") else "".join(DIGITS.findall(found))
    return f"{kind}:{value}"


def _apart(words: list[re.Match], spans: list[tuple[str, int, int]]) -> list[re.Match]:
    """Words that overlap no span."""
    if not spans:
        return words
    taken = sorted((s, e) for _, s, e in spans)
    out, place = [], 0
    furthest = 0
    for word in words:
        while place < len(taken) and taken[place][0] < word.end():
            furthest = max(furthest, taken[place][1])
            place += 1
        if word.start() >= furthest:
            out.append(word)
    return out


def _like_name(text: str, word: re.Match) -> bool:
    """Whether a word holds a digit, or begins with a capital where no sentence begins."""
    if DIGITS.search(word[0]):
        return True
    if not word[0][0].isupper():
        return False
    before = text[max(0, word.start() - 4) : word.start()].rstrip(" ")
    return bool(before) and before[-1] not in ".!?:\n\r\t"


@dataclass
class Observed:
    """What one text tells: its terms, and per entity a mark of its surroundings and the
    names and numbers near it."""

    terms: set[str]
    marks: dict[str, int]
    near: dict[str, set[str]]


def observe(text: str) -> Observed:
    spans = base_spans(text)
    if not spans:
        return Observed({w.lower() for w in WORD.findall(text)}, {}, {})
    terms = _apart(list(WORD.finditer(text)), spans)
    term_starts = [w.start() for w in terms]
    words = _apart(list(PLAIN.finditer(text)), spans)
    starts = [w.start() for w in words]
    marks: dict[str, int] = {}
    near: dict[str, set[str]] = {}
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        entity = _entity(kind, text[start:end])
        if entity not in marks:
            place = bisect_left(starts, start)
            around = " ".join(w[0].lower() for w in words[max(0, place - WINDOW) : place + WINDOW])
            marks[entity] = xxhash.xxh64_intdigest(around.encode("utf-8", "surrogatepass")) % MARKS
        place = bisect_left(term_starts, start)
        close = terms[max(0, place - NEAR) : place + NEAR]
        near.setdefault(entity, set()).update(w[0].lower() for w in close if _like_name(text, w))
    return Observed({w[0].lower() for w in terms}, marks, near)


OBSERVED = (
    "term string, n bigint, text string, entities array<struct<entity:string,mark:int>>, near array<struct<entity:string,term:string,mark:int>>"
)
_ENTITIES = pa.list_(pa.struct([("entity", pa.string()), ("mark", pa.int32())]))
_CLOSE = pa.list_(pa.struct([("entity", pa.string()), ("term", pa.string()), ("mark", pa.int32())]))


def _observations(docs: DataFrame, text: str) -> DataFrame:
    """One pass: counts of terms, added up per task, and the texts that hold an entity.

    A row has either a term with its number of texts, or a text with its entities and what is near them.
    """
    common.ship_code(docs.sparkSession)

    def counted(held: Counter) -> pa.RecordBatch:
        size = len(held)
        columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64()), pa.nulls(size, pa.string()), pa.nulls(size, _ENTITIES), pa.nulls(size, _CLOSE)]
        return pa.RecordBatch.from_arrays(columns, names=["term", "n", "text", "entities", "near"])

    def held_text(body: str, found: Observed) -> pa.RecordBatch:
        entities = [{"entity": e, "mark": m} for e, m in found.marks.items()]
        close = [{"entity": e, "term": t, "mark": found.marks[e]} for e, names in found.near.items() for t in sorted(names)]
        columns = [pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), pa.array([body], pa.string()), pa.array([entities], _ENTITIES), pa.array([close], _CLOSE)]
        return pa.RecordBatch.from_arrays(columns, names=["term", "n", "text", "entities", "near"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0):
                body = value.as_py() or ""
                found = observe(body)
                held.update(found.terms)
                if found.marks:
                    yield held_text(body, found)
                if len(held) > HELD_TERMS:
                    yield counted(held)
                    held.clear()
        yield counted(held)

    return docs.select(text).mapInArrow(run, OBSERVED)


def _mark_bit(mark: str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.col(mark))


def _recurring_pairs(texts: DataFrame, counts: DataFrame) -> DataFrame:
    """(entity, term, together, marks) for entities of SUPPORT surroundings or more.

    Entities that stand in the same texts are one, named by their number and the
    exclusive or of their hashes.
    """
    spark = texts.sparkSession
    listed = texts.select("row", F.explode("entities").alias("e")).select("row", "e.entity", "e.mark")
    known = listed.groupBy("entity").agg(F.count(F.lit(1)).alias("texts"), F.bit_or(_mark_bit("mark")).alias("marks"), F.bit_xor(F.xxhash64("row")).alias("place"))
    known = known.where(F.bit_count("marks") >= SUPPORT).select("entity", F.xxhash64("texts", "place").alias("group"), "texts")
    known = materialise(known, scratch_path(spark, "entities"))
    most = known.agg(F.max("texts")).first()[0]
    if most is None:
        return spark.createDataFrame([], "entity bigint, term string, together bigint, marks bigint")
    # A term of twice as many texts as any entity has can't be explained by one.
    frequent = counts.where(F.col("with_term") >= 2 * most).orderBy(F.desc("with_term"), "term").limit(COMMON_TERMS)
    common_terms = frozenset(row[0] for row in frequent.select("term").collect())
    # One entity may be in a third of all texts: its rows are spread by text.
    own = spread_lookup(listed, known.select("entity", "group"), ["entity"], ["row"], "inner")
    own = own.groupBy("row", "group").agg(F.min("mark").alias("mark"))
    own = own.groupBy("row").agg(F.collect_list(F.struct("group", "mark")).alias("groups"))
    rows = texts.select("row", "text").join(own, "row").select("text", "groups")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, str], list[int]] = {}

        def flush() -> pa.RecordBatch:
            columns = [[g for g, _ in held], [t for _, t in held], [v[0] for v in held.values()], [v[1] for v in held.values()]]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["entity", "term", "together", "marks"])

        for batch in batches:
            for value, groups in zip(batch.column(0), batch.column(1), strict=True):
                terms = observe(value.as_py()).terms - common_terms
                for group in groups.as_py():
                    bit = 1 << group["mark"]
                    for term in terms:
                        entry = held.setdefault((group["group"], term), [0, 0])
                        entry[0] += 1
                        entry[1] |= bit
                    if len(held) > HELD_TERMS:
                        yield flush()
                        held.clear()
        yield flush()

    found = rows.mapInArrow(run, "entity bigint, term string, together bigint, marks bigint")
    return found.groupBy("entity", "term").agg(F.sum("together").alias("together"), F.bit_or("marks").alias("marks"))


def disclosing_terms(docs: DataFrame, text: str = "text", generalise: float = GENERALISE) -> DataFrame:
    """(term, disclosure) of terms that reveal an entity, from all texts of ``docs``."""
    spark = docs.sparkSession
    path = scratch_path(spark, "disclosing")
    with scratch_scope(spark):
        return materialise(_disclosing(docs, text, generalise), path)


def _disclosing(docs: DataFrame, text: str, generalise: float) -> DataFrame:
    spark = docs.sparkSession
    seen = materialise(_observations(docs, text), scratch_path(spark, "observed"))
    counts = seen.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("with_term"))
    counts = materialise(counts, scratch_path(spark, "term-counts"))
    # Numbers of rows of a written table, so that they stay the same whenever they are read.
    numbered = seen.where("text IS NOT NULL").withColumn("row", F.monotonically_increasing_id())
    texts = materialise(numbered.select("row", "text", "entities", "near"), scratch_path(spark, "entity-texts"))
    near = texts.select(F.explode("near").alias("e")).select("e.entity", "e.term", "e.mark")
    near = near.groupBy("entity", "term").agg(F.count(F.lit(1)).alias("together"), F.bit_or(_mark_bit("mark")).alias("marks"))
    near = near.select(F.xxhash64("entity").alias("entity"), "term", "together", "marks", F.lit(NAMED).alias("more"))
    pairs = near.unionByName(_recurring_pairs(texts, counts).withColumn("more", F.lit(0)))
    # A term may be near very many entities.
    joined = spread_lookup(pairs, counts, ["term"], ["entity"], "inner")
    share = F.col("together") / F.col("with_term")
    disclosure = least_share(share, F.bit_count("marks") + F.col("more"))
    rated = joined.where(share > generalise).withColumn("disclosure", disclosure)
    return rated.where(F.col("disclosure") >= generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure"))


def least_share(share: Column, surroundings: Column) -> Column:
    """Wilson's lower bound of a share, from as many of its cases as there are surroundings."""
    size, squared = surroundings / share, QUANTILE**2
    spread = QUANTILE * F.sqrt(F.greatest(share * (1.0 - share), F.lit(0.0)) / size + squared / (4.0 * size * size))
    return (share + squared / (2.0 * size) - spread) / (1.0 + squared / size)


@dataclass(frozen=True)
class Replacements:
    removed: frozenset[str]
    generalised: frozenset[str]

    def any(self) -> bool:
        return bool(self.removed or self.generalised)

    def hit(self, terms: set[str]) -> bool:
        return not (self.removed.isdisjoint(terms) and self.generalised.isdisjoint(terms))


def _replacement(kind: str, word: str) -> str:
    # Also where it would be removed: that a text has figures discloses nothing.
    if DIGITS.search(word):
        return "[NUMBER]"
    if kind == "removed":
        return ""
    return "[NAME]" if word[:1].isupper() else "[TERM]"


def sanitise(text: str, found: Replacements) -> tuple[list[tuple[str, int, int]], str]:
    """Spans, base ones first, and the text with every span replaced."""
    base = base_spans(text)
    added = []
    if found.any() and found.hit({w.lower() for w in WORD.findall(text)}):
        for word in _apart(list(WORD.finditer(text)), base):
            term = word[0].lower()
            if term in found.removed or term in found.generalised:
                added.append(("removed" if term in found.removed else TERM, word.start(), word.end()))
    spans = [*base, *((TERM, s, e) for _, s, e in added)]
    if not spans:
        return spans, text
    parts, end = [], 0
    for kind, start, stop in sorted([*base, *added], key=lambda s: (s[1], -s[2])):
        if stop <= end:
            continue
        parts.append(text[end : max(start, end)])
        parts.append(f"[{kind.upper()}]" if kind in KINDS else _replacement(kind, text[start:stop]))
        end = stop
    parts.append(text[end:])
    return spans, "".join(parts)


SPANS = pa.list_(pa.struct([pa.field("kind", pa.string(), False), pa.field("start", pa.int64(), False), pa.field("end", pa.int64(), False)]))


def _arrow(results: list[tuple[list[tuple[str, int, int]], str]]) -> list[pa.Array]:
    spans = [[{"kind": k, "start": s, "end": e} for k, s, e in spans] for spans, _ in results]
    return [pa.array(spans, SPANS), pa.array([text for _, text in results], pa.string())]


def apply(docs: DataFrame, terms: DataFrame, text: str = "text", keep: list[str] | None = None, sent_chars: int = SENT_CHARS) -> DataFrame:
    """Add ``spans`` and ``sanitised`` to every row.

    Spans are (kind, start, end) in code points: base spans by kind, then start, and then terms
    by start. A null text counts as empty. Input columns named like the added ones
    are replaced. ``terms`` (term, disclosure) is sent to the tasks while its text is small,
    else it is joined to the words of the texts; both give the same rows.
    """
    spark = docs.sparkSession
    terms = terms.select("term", (F.col("disclosure") >= REMOVE).alias("removed"))
    size = terms.agg(F.coalesce(F.sum(F.length("term") + 1), F.lit(0))).first()[0]
    if size <= sent_chars:
        known = terms.collect()
        found = Replacements(frozenset(r["term"] for r in known if r["removed"]), frozenset(r["term"] for r in known if not r["removed"]))
        return common.add_columns(docs, [text], COLUMNS, lambda values: _arrow([sanitise(t or "", found) for t in values[text]]), keep)
    return _apply_joined(docs, terms, text, keep)


def _apply_joined(docs: DataFrame, terms: DataFrame, text: str, keep: list[str] | None) -> DataFrame:
    """Each text's own disclosing terms are found by a join, and travel with the text."""
    spark = docs.sparkSession
    names = docs.columns if keep is None else keep
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    numbered = materialise(numbered, scratch_path(spark, "numbered"))
    words = StructType([StructField("__words", ArrayType(StringType(), False), False)])

    def list_words(values: dict[str, list]) -> list[pa.Array]:
        return [pa.array([sorted({w.lower() for w in WORD.findall(t or "")}) for t in values[text]], pa.list_(pa.string()))]

    listed = common.add_columns(numbered.select("__row", text), [text], words, list_words, ["__row"])
    own = listed.select("__row", F.explode("__words").alias("term")).join(terms, "term")
    own = own.groupBy("__row").agg(F.collect_list(F.when(F.col("removed"), F.col("term"))).alias("__removed"), F.collect_list(F.when(~F.col("removed"), F.col("term"))).alias("__general"))
    joined = numbered.join(own, "__row", "left")

    def compute(values: dict[str, list]) -> list[pa.Array]:
        rows = zip(values[text], values["__removed"], values["__general"], strict=True)
        return _arrow([sanitise(t or "", Replacements(frozenset(r or ()), frozenset(g or ()))) for t, r, g in rows])

    return common.add_columns(joined, [text, "__removed", "__general"], COLUMNS, compute, names)


def protect(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Learn disclosing terms from all texts, then find and replace in all of them."""
    return apply(docs, disclosing_terms(docs, text), text, keep)


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _number(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")


def digests(found: DataFrame) -> DataFrame:
    base = F.filter("spans", lambda s: s["kind"] != TERM)
    return found.select("doc_id", *[_number(kind) for kind in KINDS], F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(protect(docs, keep=["doc_id"]))
