"""Secrets in texts: fixed forms, and strings that pass a battery of randomness tests.

Only DataFrame functions are used. Base spans follow fixed patterns. Beyond them, long runs of
letters, digits and the separators ``+ / _ = -`` are candidates. What is tested of a run are
its parts between separators, each for itself (so a key behind a path is), and all parts
joined where most of their characters lie in parts that mix letters and digits (so a hyphenated or base64
key is, and a slug of words and numbers isn't). A part is tested if it mixes letters and
digits and has LEAST_CHARS, or is all letters and has LEAST_LETTERS, more than words have.

The encoding is inferred from the characters, the narrowest that fits; under the hypothesis
that a string is random over that alphabet, a chi-squared test
of uniformity, a runs test (upper against lower half of the alphabet) and a test of serial
correlation give three p-values. The latter two look at the order of the characters and
depend on each other, so the smaller one is doubled; it is independent of the first, which
looks at their numbers, and both are combined by Fisher's method. Strings are cleared as
structured where the hypothesis is rejected under false-discovery control (Benjamini and
Hochberg) per length band, since short strings tell less; so among cleared strings the
expected share of random ones is at most FALSE_SHARE. A run with a string that isn't cleared is a span.

Nulls and empty texts have no span. Very long texts and runs are read whole. Ties: spans that
begin at one place are in the order of their kinds. Repeated rows count one by one in the control, and get
equal spans. An empty table gives no row. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.sources.lake import materialise, scratch_path

# The base patterns.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$"""
# A greedy run of one class is kept or dropped whole, so its least length can be asked for.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
ASSIGN_CHARS = 8
KINDS = ("assign", "access", "hex")
RANDOM = "random"

LEAST_CHARS, LEAST_LETTERS = 16, 24
CANDIDATE = rf"[A-Za-z0-9+/_=-]{{{LEAST_CHARS},}}"
PART = "[A-Za-z0-9]+"
DIGIT, LETTER = "[0-9]", "[A-Za-z]"
FALSE_SHARE = 0.05
# Length bands are powers of two from LEAST_CHARS; p-values are counted in tenths of a
# power of ten, up to 30.
BANDS = 12
BINS = 300
SLICE = 256

DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Inferred encodings, the narrowest that fits: pattern and alphabet in order.
ENCODINGS = (
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[A-Z]+$", UPPER),
    (r"^[a-z]+$", LOWER),
    (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[a-z2-7]+$", LOWER + "234567"),
    (r"^[A-Z0-9]+$", DIGITS + UPPER),
    (r"^[a-z0-9]+$", DIGITS + LOWER),
    (r"^[A-Za-z]+$", UPPER + LOWER),
    (r"", DIGITS + UPPER + LOWER),
)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array of (start, end, found), in code points.

    Each match is read with the text since the one before, anchored there, so positions
    are running sums of lengths. Sums run over slices, to keep long lists cheap.
    """
    stepped = rf"\G(?s)(.*?)({pattern})"
    parts = F.arrays_zip(F.regexp_extract_all(text, F.lit(stepped), F.lit(1)).alias("gap"), F.regexp_extract_all(text, F.lit(stepped), F.lit(2)).alias("found"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,found:string>>")

    def one(state: Column, part: Column) -> Column:
        start = state["at"] + F.length(part["gap"])
        end = start + F.length(part["found"])
        span = F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), part["found"].alias("found"))
        return F.struct(end.cast("bigint").alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    def sliced(state: Column, part: Column) -> Column:
        begin = F.struct(state["at"].alias("at"), none.alias("spans"))
        return let(F.aggregate(part, begin, one), lambda own: F.struct(own["at"].alias("at"), F.concat(state["spans"], own["spans"]).alias("spans")))

    def over(all_parts: Column) -> Column:
        last = F.floor((F.size(all_parts) - 1) / SLICE).cast("int")
        slices = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(all_parts, i * SLICE + 1, F.lit(SLICE)))
        return F.aggregate(slices, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans")), sliced)["spans"]

    return F.when(F.rlike(text, F.lit(pattern)), let(parts, over)).otherwise(none)


def upper_tail(z: Column) -> Column:
    """Probability of a standard normal value of at least z >= 0 (a fixed approximation
    to seven digits)."""
    t = 1.0 / (1.0 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2.0) * 0.3989422804014327 * poly


def _two_sided(z: Column) -> Column:
    return F.least(F.lit(1.0), 2.0 * upper_tail(F.least(F.abs(z), F.lit(30.0))))


def _one_sided(z: Column) -> Column:
    tail = upper_tail(F.least(F.abs(z), F.lit(30.0)))
    return F.when(z >= 0, tail).otherwise(1.0 - tail)


def _codes(token: Column, alphabet: str) -> Column:
    return F.transform(F.split(token, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))


def battery(token: Column) -> Column:
    """Combined p-value of the three tests under the inferred encoding, for letters and digits."""
    codes = F.lit(None).cast("array<double>")
    size = F.lit(None).cast("double")
    for pattern, alphabet in reversed(ENCODINGS):
        fits = F.rlike(token, F.lit(pattern)) if pattern else F.lit(True)
        codes = F.when(fits, _codes(token, alphabet)).otherwise(codes)
        size = F.when(fits, F.lit(float(len(alphabet)))).otherwise(size)

    def combined(v: Column, k: Column) -> Column:
        n = F.size(v).cast("double")
        tally = F.aggregate(
            F.array_distinct(v), F.lit(0.0), lambda total, c: total + F.pow(F.size(F.filter(v, lambda x: x == c)).cast("double"), F.lit(2.0))
        )
        spread, degrees = tally * k / n - n, k - 1.0
        # Sparse counts: the variance is smaller than that of the limit by (n - 1) / n.
        scaled = degrees + (spread - degrees) / F.sqrt((n - 1.0) / n)
        root = F.pow(F.greatest(scaled, F.lit(0.0)) / degrees, F.lit(1.0 / 3.0))
        uniform = _one_sided((root - (1.0 - 2.0 / (9.0 * degrees))) / F.sqrt(2.0 / (9.0 * degrees)))

        pairs = F.zip_with(F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
        upper = F.size(F.filter(v, lambda x: x >= k / 2.0)).cast("double")
        lower = n - upper
        changes = F.size(F.filter(pairs, lambda p: (p["a"] >= k / 2.0) != (p["b"] >= k / 2.0))).cast("double")
        product = 2.0 * upper * lower
        variance = product * (product - n) / (n * n * (n - 1.0))
        runs = F.when(variance > 0, _two_sided((changes - product / n) / F.sqrt(F.greatest(variance, F.lit(1e-9))))).otherwise(F.pow(F.lit(2.0), 1.0 - n))

        mean = F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / n
        squares = F.aggregate(v, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
        products = F.aggregate(pairs, F.lit(0.0), lambda s, p: s + (p["a"] - mean) * (p["b"] - mean))
        serial = F.when(squares > 0, _two_sided((products / squares + 1.0 / n) * F.sqrt(n))).otherwise(F.lit(1e-30))

        order = F.least(F.lit(1.0), 2.0 * F.least(runs, serial))
        half = -(F.ln(F.greatest(uniform, F.lit(1e-30))) + F.ln(F.greatest(order, F.lit(1e-30))))
        return F.exp(-half) * (1.0 + half)

    def with_size(both: Column) -> Column:
        return F.when(F.size(both["v"]) >= 3, combined(both["v"], both["k"])).otherwise(F.lit(1e-30))

    return let(F.struct(codes.alias("v"), size.alias("k")), with_size)


def band(token: Column) -> Column:
    size = F.length(token) / F.lit(float(LEAST_CHARS))
    return F.least(F.floor(F.log2(size)), F.lit(BANDS - 1)).cast("int")


def tenth(p: Column) -> Column:
    """The bin of a p-value: whole tenths of its negative power of ten."""
    return F.least(F.floor(-10.0 * F.log10(F.greatest(p, F.lit(1e-30)))), F.lit(BINS)).cast("int")


def mixed(token: Column) -> Column:
    """Whether a string holds a digit and a letter."""
    return F.rlike(token, F.lit(DIGIT)) & F.rlike(token, F.lit(LETTER))


def tested(run: Column) -> Column:
    """The strings of a run that are tested: long parts, and all of them joined."""

    def long_enough(part: Column) -> Column:
        return ((F.length(part) >= LEAST_CHARS) & mixed(part)) | ((F.length(part) >= LEAST_LETTERS) & ~F.rlike(part, F.lit(DIGIT)))

    def chosen(parts: Column) -> Column:
        whole = F.array_join(parts, "")
        in_mixed = F.aggregate(F.filter(parts, mixed), F.lit(0), lambda n, part: n + F.length(part))
        joins = (F.size(parts) > 1) & (F.length(whole) >= LEAST_CHARS) & (2 * in_mixed >= F.length(whole))
        return F.concat(F.filter(parts, long_enough), F.when(joins, F.array(whole)).otherwise(F.array().cast("array<string>")))

    return let(F.regexp_extract_all(run, F.lit(PART), F.lit(0)), chosen)


def cleared_from(counts: dict[tuple[int, int], int], share: float = FALSE_SHARE) -> dict[int, int]:
    """Per length band the lowest bin whose strings, and those of higher bins, are cleared.

    The step-up rule is applied to binned p-values at their largest value, so binning
    can only clear less.
    """
    first = {}
    for own in {b for b, _ in counts}:
        total = sum(n for (b, _), n in counts.items() if b == own)
        reached, lowest = 0, BINS + 1
        for place in range(BINS, -1, -1):
            reached += counts.get((own, place), 0)
            if reached and 10.0 ** (-place / 10.0) <= share * reached / total:
                lowest = place
        first[own] = lowest
    return first


def measure(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``base``, the spans of the fixed patterns, and ``__runs``: where each run with tested
    strings is, and the length band and the bin of the p-value of each of these."""
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in {"secrets", "base"}]
    body = F.coalesce(F.col("__text"), F.lit(""))
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").alias("__text"))
    source = source.withColumns({f"__{kind}": located(body, pattern) for kind, pattern in zip((*KINDS, RANDOM), (ASSIGN, ACCESS, HEX, CANDIDATE), strict=True)})

    def labelled(kind: str, place: int) -> Column:
        spans = F.col(f"__{kind}")
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["found"], ASSIGN_VALUE, 1)) >= ASSIGN_CHARS)
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), s["end"].alias("end")))

    def levels(span: Column) -> Column:
        rated = F.transform(tested(span["found"]), lambda t: F.struct(band(t).alias("band"), tenth(battery(t)).alias("bin")))
        return F.struct(span["start"].alias("start"), span["end"].alias("end"), rated.alias("levels"))

    base = F.array_sort(F.concat(*[labelled(kind, place) for place, kind in enumerate(KINDS)]))
    runs = F.filter(F.transform(F.col(f"__{RANDOM}"), levels), lambda run: F.size(run["levels"]) > 0)
    return source.select(*[F.col(f"`{c}`") for c in kept], base.alias("base"), runs.alias("__runs"))


def learn(measured: DataFrame) -> dict[int, int]:
    """Clearing bins per length band, from every tested string of ``measure``."""
    levels = measured.select(F.explode("__runs.levels").alias("levels")).select(F.explode("levels").alias("level"))
    # At most BANDS * (BINS + 1) rows.
    return cleared_from({(r[0], r[1]): r[2] for r in levels.groupBy("level.band", "level.bin").count().collect()})


def settle(measured: DataFrame, cleared: dict[int, int]) -> DataFrame:
    """``secrets`` of measured rows: base spans, and runs with a string that isn't cleared."""

    def uncleared(run: Column) -> Column:
        apart = ~F.exists(F.col("base"), lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

        def below(level: Column) -> Column:
            limit = F.lit(BINS + 1)
            for own, lowest in sorted(cleared.items()):
                limit = F.when(level["band"] == own, F.lit(lowest)).otherwise(limit)
            return level["bin"] < limit

        return apart & F.exists(run["levels"], below)

    added = F.transform(
        F.filter(F.col("__runs"), uncleared),
        lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("place"), F.lit(RANDOM).alias("kind"), s["end"].alias("end")),
    )
    return measured.withColumn("secrets", F.array_sort(F.concat("base", added))).drop("__runs")


def fit(docs: DataFrame, text: str = "text") -> dict[int, int]:
    """Clearing bins per length band, from every candidate of every text."""
    return learn(measure(docs, text, []))


def find(docs: DataFrame, cleared: dict[int, int], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add ``secrets``, the spans (start, place, kind, end) in order, and ``base``, those of
    the fixed patterns alone, to every row. Positions are code points, ends exclusive.

    A random run that overlaps a base span isn't added.
    """
    return settle(measure(docs, text, keep), cleared)


def scan(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``find`` with the bins that these documents give. Texts are read once: what was measured
    of them is written, and read for the bins and for the spans."""
    measured = materialise(measure(docs, text, keep), scratch_path(docs.sparkSession, "measured"))
    return settle(measured, learn(measured))


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def digests(found: DataFrame) -> DataFrame:
    def number(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return found.select("doc_id", *[number(k) for k in KINDS], F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return digests(scan(docs, keep=["doc_id"]))


def oracle() -> str:
    """The same spans, tests and clearing in SQL."""
    alphabets = " ".join(f"WHEN regexp_matches(t, '{pattern}') THEN '{alphabet}'" for pattern, alphabet in ENCODINGS[:-1])
    is_mixed = f"regexp_matches(p, '{DIGIT}') AND regexp_matches(p, '{LETTER}')"
    is_long = f"(length(p) >= {LEAST_CHARS} AND {is_mixed}) OR (length(p) >= {LEAST_LETTERS} AND NOT regexp_matches(p, '{DIGIT}'))"
    whole = ENCODINGS[-1][1]
    assign = ASSIGN.replace("'", "''").replace(r"\x20", " ")
    value = ASSIGN_VALUE.replace("'", "''").replace(r"\x20", " ")

    def kind(name: str, place: int, pattern: str) -> str:
        gaps, found = (f"regexp_extract_all(body, '(?s)(.*?)({pattern})', {group})" for group in (1, 2))
        return f"SELECT row_no, '{name}' AS kind, {place} AS place, {gaps} AS gaps, {found} AS matches FROM docs"

    tail = "(exp(-z * z / 2.0) * 0.3989422804014327 * (u * (0.319381530 + u * (-0.356563782 + u * (1.781477937 + u * (-1.821255978 + u * 1.330274429))))))"
    return f"""
WITH docs AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS body FROM documents),
listed AS ({kind("assign", 0, assign)} UNION ALL {kind("access", 1, ACCESS)} UNION ALL {kind("hex", 2, HEX)} UNION ALL {kind(RANDOM, 3, CANDIDATE)}),
single AS (SELECT row_no, kind, place, unnest(gaps) AS gap, unnest(matches) AS t, generate_subscripts(matches, 1) AS i FROM listed WHERE len(matches) > 0),
spans AS (
  SELECT row_no, kind, place, t, e - length(t) AS s, e FROM (
    SELECT *, sum(length(gap) + length(t)) OVER (PARTITION BY row_no, kind ORDER BY i) AS e FROM single)),
base AS (SELECT * FROM spans WHERE kind <> '{RANDOM}' AND (kind <> 'assign' OR length(regexp_extract(t, '{value}', 1)) >= {ASSIGN_CHARS})),
runs AS (SELECT row_number() OVER () AS run, row_no, s, e, regexp_extract_all(t, '{PART}') AS parts FROM spans WHERE kind = '{RANDOM}'),
joined_runs AS (SELECT *, array_to_string(parts, '') AS whole, coalesce(list_sum([length(p) FOR p IN parts IF {is_mixed}]), 0) AS in_mixed FROM runs),
strings AS (
  SELECT run, unnest(list_concat([p FOR p IN parts IF {is_long}],
    CASE WHEN len(parts) > 1 AND length(whole) >= {LEAST_CHARS} AND 2 * in_mixed >= length(whole) THEN [whole] ELSE [] END)) AS t FROM joined_runs),
tokens AS (SELECT row_number() OVER () AS id, run, t, CASE {alphabets} ELSE '{whole}' END AS alphabet FROM strings),
coded AS (SELECT id, length(alphabet)::DOUBLE AS k, [(instr(alphabet, c) - 1)::DOUBLE FOR c IN string_split(t, '')] AS v FROM tokens),
chars AS (SELECT id, k, len(v)::DOUBLE AS n, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM coded WHERE len(v) >= 3),
steps AS (SELECT *, lag(x) OVER (PARTITION BY id ORDER BY i) AS before, avg(x) OVER (PARTITION BY id) AS mean FROM chars),
tallies AS (SELECT id, sum(c * c)::DOUBLE AS tally FROM (SELECT id, x, count(*) AS c FROM chars GROUP BY ALL) GROUP BY id),
moments AS (
  SELECT id, any_value(k) AS k, any_value(n) AS n, count(*) FILTER (WHERE x >= k / 2)::DOUBLE AS up,
    count(*) FILTER (WHERE (x >= k / 2) <> (before >= k / 2))::DOUBLE AS changes,
    sum((x - mean) * (x - mean)) AS squares, sum((x - mean) * (before - mean)) AS products
  FROM steps GROUP BY id),
scaled AS (
  SELECT *, k - 1 AS df, k - 1 + (tally * k / n - n - (k - 1)) / sqrt((n - 1) / n) AS chi, 2 * up * (n - up) AS product FROM moments JOIN tallies USING (id)),
scores AS (
  SELECT id, (pow(greatest(chi, 0) / df, 1.0 / 3) - (1 - 2 / (9 * df))) / sqrt(2 / (9 * df)) AS z1,
    CASE WHEN product * (product - n) > 0 THEN (changes - product / n) / sqrt(product * (product - n) / (n * n * (n - 1))) END AS z2,
    CASE WHEN squares > 0 THEN (products / squares + 1 / n) * sqrt(n) END AS z3, n FROM scaled),
sides AS (SELECT id, n, j, [z1, z2, z3][j] AS raw, least(abs([z1, z2, z3][j]), 30) AS z, 1 / (1 + 0.2316419 * least(abs([z1, z2, z3][j]), 30)) AS u
  FROM scores CROSS JOIN range(1, 4) AS g(j)),
levels AS (
  SELECT id, greatest(max(CASE WHEN j = 1 THEN CASE WHEN raw >= 0 THEN {tail} ELSE 1 - {tail} END END), 1e-30) AS p1,
    greatest(least(1, 2 * min(CASE WHEN j > 1 THEN CASE WHEN raw IS NOT NULL THEN least(1, 2 * {tail}) WHEN j = 2 THEN pow(2, 1 - n) ELSE 1e-30 END END)), 1e-30) AS p2
  FROM sides GROUP BY id),
binned AS (
  SELECT t.id, run, least(floor(log2(length(t) / {float(LEAST_CHARS)})), {BANDS - 1}) AS band,
    least(floor(-10 * log10(greatest(coalesce(p1 * p2 * (1 - ln(p1 * p2)), 1e-30), 1e-30))), {BINS}) AS bin
  FROM tokens t LEFT JOIN levels USING (id)),
ranked AS (
  SELECT band, bin, count(*) AS n, sum(count(*)) OVER (PARTITION BY band ORDER BY bin DESC) AS reached, sum(count(*)) OVER (PARTITION BY band) AS total
  FROM binned GROUP BY band, bin),
cleared AS (SELECT band, min(bin) AS lowest FROM ranked WHERE pow(10, -bin / 10.0) <= {FALSE_SHARE} * reached / total GROUP BY band),
added AS (
  SELECT r.row_no, '{RANDOM}' AS kind, 3 AS place, r.s, r.e FROM runs r
  WHERE run IN (SELECT run FROM binned LEFT JOIN cleared USING (band) WHERE bin < coalesce(lowest, {BINS + 1}))
    AND NOT EXISTS (SELECT 1 FROM base o WHERE o.row_no = r.row_no AND o.s < r.e AND r.s < o.e)),
every AS (SELECT row_no, kind, place, s, e FROM base UNION ALL SELECT * FROM added),
joined AS (
  SELECT row_no, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) FILTER (WHERE place < 3) AS base_spans, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, place) AS spans
  FROM every GROUP BY row_no)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base_spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN joined USING (row_no)"""
