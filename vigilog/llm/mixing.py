"""Mixing documents to target weights by iterative proportional fitting.

Tokens are counted per cell of (source, language, topic). The cells' weights are raked to one
marginal after the other until the weighted tokens match the targets of all three. A
document is then sampled with a probability that its cell's weight leads to, and none is taken twice.

Probabilities take a given share of all tokens. They end at 1, and the raking is done under that
bound: a cell or a value without enough tokens is taken whole, the others make up for it,
and the shortfall is reported. Or, without a share, weights are scaled so that the largest
is 1; then targets are met exactly, but the rarest wanted cell bounds the whole sample.

Nulls: a null source, language or topic counts as OTHER, a null text has no tokens, a null key is one key. Empty
texts get the weight of their cell and add nothing to it; very long ones count as many tokens as they have. Ties: rows of
equal key, repeated rows among them, are sampled together. An empty table gives no row. Input columns
named like the added ones are replaced.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG = logging.getLogger(__name__)

OTHER = "other"
ROUNDS = 60
DIGITS = 9
SEED = "mix-1"
AXES = ("source", "lang", "topic")
# The part of all tokens that is sampled, if not said otherwise.
SHARE = 0.5
BOUNDED_ROUNDS = 300
# A value is reported as short below this part of its target.
SHORT = 0.999

# Target shares of tokens. Values of an axis that aren't listed share what OTHER gets.
TARGETS = {
    "source": {"src0": 0.14, **{f"src{i}": 0.045 for i in range(1, 20)}, OTHER: 0.005},
    "lang": {"en": 0.55, "de": 0.16, "fr": 0.16, "es": 0.12, OTHER: 0.01},
    "topic": {"prose": 0.80, "note": 0.09, "figures": 0.07, "contact": 0.015, "notice": 0.025},
}


def tokens(text: str = "text") -> Column:
    """White-space separated words of a text; 0 for a null."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("bigint")


def topic(text: str = "text", sanitised: bool = True) -> Column:
    """A text's kind, from its first mark that fits: licence notice, contact data,
    figures, short note, or prose. A null text is a note.

    With ``sanitised`` a mark also is what ``privacy`` writes in its place: [EMAIL] for an at
    sign, the other kinds for digits, so replaced personal data leaves a text its kind.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    contact, figures = F.contains(body, F.lit("@")), "[0-9]"
    if sanitised:
        contact, figures = contact | F.contains(body, F.lit("[EMAIL]")), r"[0-9]|\[(?:IP|CARD|PHONE|NUMBER)\]"
    return (
        F.when(F.contains(body, F.lit("Licensed")) | F.contains(body, F.lit("Copyright")), "notice")
        .when(contact, "contact")
        .when(F.regexp_like(body, F.lit(figures)), "figures")
        .when(F.length(body) < 1000, "note")
        .otherwise("prose")
    )


def listed(value: Column, shares: dict[str, float]) -> Column:
    return F.when(value.isin(*[k for k in shares if k != OTHER]), value).otherwise(F.lit(OTHER))


def rake(cells: dict[tuple, int], targets: dict[str, dict[str, float]], rounds: int = ROUNDS) -> dict[tuple, float]:
    """Weight per cell so that weighted tokens have the target shares on every axis.

    Shares of values without tokens are given to the others in proportion. Cells without
    tokens get weight 0.
    """
    total = float(sum(cells.values()))
    fitted = {cell: float(count) for cell, count in sorted(cells.items()) if count > 0}
    goals = []
    for axis, shares in enumerate(targets.values()):
        present = sorted({cell[axis] for cell in fitted})
        whole = sum(shares.get(v, 0.0) for v in present)
        goals.append({v: shares.get(v, 0.0) / whole * total if whole > 0 else 0.0 for v in present})
    for _ in range(rounds):
        for axis, goal in enumerate(goals):
            sums = dict.fromkeys(goal, 0.0)
            for cell, value in fitted.items():
                sums[cell[axis]] += value
            fitted = {c: v * goal[c[axis]] / sums[c[axis]] if sums[c[axis]] > 0 else 0.0 for c, v in fitted.items()}
    weights = {cell: value / cells[cell] for cell, value in fitted.items()}
    return {cell: weights.get(cell, 0.0) for cell in cells}


def rake_bounded(cells: dict[tuple, int], targets: dict[str, dict[str, float]], share: float, rounds: int = BOUNDED_ROUNDS) -> dict[tuple, float]:
    """Probability per cell, at most 1, that takes ``share`` of all tokens.

    The tokens taken have the target shares on every axis as far as there are enough. A value
    with too few tokens is taken whole, and what it lacks is given to the others in proportion.
    Within a value, cells at probability 1 stay there and the others are raised. Targets
    that only contradict each other through the cells' bounds are met on the last axis.
    """
    total = float(sum(cells.values()))
    present = {cell: float(count) for cell, count in sorted(cells.items()) if count > 0}
    goals = []
    for axis, shares in enumerate(targets.values()):
        tokens_of = dict.fromkeys(sorted({cell[axis] for cell in present}), 0.0)
        for cell, count in present.items():
            tokens_of[cell[axis]] += count
        scale = _scale_to(share, {v: shares.get(v, 0.0) * total / n for v, n in tokens_of.items()}, tokens_of)
        goals.append({v: n * min(1.0, shares.get(v, 0.0) * total / n * scale) for v, n in tokens_of.items()})
    factors = dict.fromkeys(present, 1.0)
    taken = {}
    for _ in range(rounds):
        before = taken
        for axis, goal in enumerate(goals):
            for value, wanted in goal.items():
                own = sorted((c for c in present if c[axis] == value), key=lambda c: factors[c])
                # As many cells as possible from the smallest factor on share what is left when
                # the others are at 1. Sums start at the smallest, since factors differ widely.
                raised, left, rest = 1.0 / factors[own[0]], wanted - sum(present[c] for c in own), 0.0
                for c in own:
                    left, rest = left + present[c], rest + present[c] * factors[c]
                    if left > 0 and left / rest * factors[c] <= 1.0:
                        raised = left / rest
                if wanted <= 0:
                    raised = 0.0
                for c in own:
                    factors[c] = min(max(factors[c] * raised, 1e-150), 1e150)
        taken = {c: min(1.0, f) for c, f in factors.items()}
        if before and all(abs(taken[c] - before[c]) <= 1e-12 for c in taken):
            break
    return {cell: taken.get(cell, 0.0) for cell in cells}


def reached(cells: dict[tuple, int], probabilities: dict[tuple, float], targets: dict[str, dict[str, float]]) -> list[tuple]:
    """(axis, value, target, reached, tokens) per axis value: its target among the values that
    have tokens, its share of the tokens expected to be taken, and all its tokens."""
    out = []
    taken = sum(n * probabilities[c] for c, n in cells.items())
    for axis, (name, shares) in enumerate(targets.items()):
        present = sorted({c[axis] for c, n in cells.items() if n > 0})
        whole = sum(shares.get(v, 0.0) for v in present)
        for value in present:
            own = [c for c in cells if c[axis] == value]
            got = sum(cells[c] * probabilities[c] for c in own)
            out.append((name, value, shares.get(value, 0.0) / whole if whole else 0.0, got / taken if taken else 0.0, sum(cells[c] for c in own)))
    return out


def uniform(key: str, seed: str = SEED) -> Column:
    """A number from 0 up to 1 for a key, the same wherever and whenever it is drawn."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col(key).cast("string"), F.lit("\\N"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint") / F.lit(float(1 << 48))


def mix(
    docs: DataFrame,
    targets: dict[str, dict[str, float]] | None = None,
    key: str = "doc_id",
    text: str = "text",
    axes: dict[str, Column] | None = None,
    share: float | None = SHARE,
    seed: str = SEED,
) -> DataFrame:
    """Add ``n_tokens``, ``mix_weight``, ``mix_probability`` and ``sampled`` to every row.

    ``targets`` names the shares per axis, ``axes`` the value of each axis for a row (default:
    columns source and lang, and ``topic``). Null values and values not listed are one value,
    ``other``, so the number of cells depends on the targets alone, and only cells reach the
    driver. ``share`` is the part of all tokens to take (``rake_bounded``); values that fall
    short of their target are logged. None scales the weights so that the largest is 1. Rows of equal key are
    sampled together; a null key counts as one key. Rows without tokens get the weight
    of their cell. Input columns named like the added ones are replaced.
    """
    targets = TARGETS if targets is None else targets
    values = axes or {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(text)}
    cell = F.struct(*[listed(values[a], targets[a]).alias(a) for a in targets])
    added = ("n_tokens", "mix_weight", "mix_probability", "sampled")
    kept = [c for c in docs.columns if c.lower() not in added]
    marked = docs.select(*[F.col(f"`{c}`") for c in kept], tokens(text).alias("n_tokens"), cell.alias("__cell"), uniform(key, seed).alias("__draw"))
    # One row per combination of listed values.
    counted = {tuple(r[0]): r[1] for r in marked.groupBy("__cell").agg(F.sum("n_tokens")).collect()}
    weights = rake(counted, targets)
    if share is None:
        scale = 1.0 / max([*weights.values(), 1e-300])
        taken = {c: w * scale for c, w in weights.items()}
    else:
        taken = rake_bounded(counted, targets, share)
    for axis, value, target, got, n in reached(counted, taken, targets):
        if got < SHORT * target:
            LOG.warning("mix: %s %s reaches %.4g of the tokens taken, its target is %.4g (it has %d tokens)", axis, value, got, target, n)
    number = F.concat_ws("\x1f", *[F.col(f"__cell.{a}") for a in targets])

    def looked_up(numbers: dict[tuple, float]) -> Column:
        entries = [F.lit(x) for c, w in sorted(numbers.items()) for x in ("\x1f".join(c), float(w))]
        return F.coalesce(F.create_map(*entries)[number], F.lit(0.0)) if entries else F.lit(0.0)

    rated = marked.withColumn("mix_weight", F.round(looked_up(weights), DIGITS)).withColumn("mix_probability", F.round(F.least(F.lit(1.0), looked_up(taken)), DIGITS))
    return rated.withColumn("sampled", F.col("__draw") < F.col("mix_probability")).drop("__cell", "__draw")


def _scale_to(share: float, weights: dict[tuple, float], counts: dict[tuple, int]) -> float:
    """The scale at which capped probabilities take ``share`` of all tokens."""
    goal, low, high = share * sum(counts.values()), 0.0, 1e12
    for _ in range(200):
        middle = (low + high) / 2
        got = sum(min(1.0, w * middle) * counts[c] for c, w in weights.items())
        low, high = (middle, high) if got < goal else (low, middle)
    return high


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source", "lang")
    # These texts are not sanitised, so their topics need no marks of that.
    axes = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic(sanitised=False)}
    return mix(docs, axes=axes).select("doc_id", "n_tokens", "mix_weight", "mix_probability", "sampled")


def oracle(share: float = SHARE, rounds: int = ROUNDS, bounded_rounds: int = BOUNDED_ROUNDS, sanitised: bool = False) -> str:
    """The same raking in SQL, without and with the bound. The targets are those of TARGETS."""
    at_sign, figures = "contains(text, '@')", "[0-9]"
    if sanitised:
        at_sign, figures = f"({at_sign} OR contains(text, '[EMAIL]'))", r"[0-9]|\[(?:IP|CARD|PHONE|NUMBER)\]"

    def value(column: str, shares: dict[str, float]) -> str:
        names = ", ".join(f"'{k}'" for k in shares if k != OTHER)
        return f"CASE WHEN {column} IN ({names}) THEN {column} ELSE '{OTHER}' END"

    listed_shares = {a: ", ".join(f"('{k}', CAST({v!r} AS DOUBLE))" for k, v in TARGETS[a].items()) for a in AXES}
    shares = ", ".join(
        f"{a}_goal AS (SELECT v AS {a}, share / sum(share) OVER () AS {a}_share FROM (VALUES {listed_shares[a]}) AS t(v, share) "
        f"WHERE v IN (SELECT {a} FROM cells WHERE n > 0))"
        for a in AXES
    )
    fit = "w"
    inner = "SELECT round, source, lang, topic, w, source_share, lang_share, topic_share FROM raked"
    for a in AXES:
        inner = f"SELECT round, source, lang, topic, {fit} * {a}_share / sum({fit}) OVER (PARTITION BY {a}) AS w, source_share, lang_share, topic_share FROM ({inner})"
    # Tokens to take of each value: all, or its share times a scale at which all values together make up the whole.
    wanted = ", ".join(
        f"""{a}_tokens AS (
  SELECT {a}, t, coalesce(share, 0) * (SELECT sum(n) FROM cells) AS s FROM (SELECT {a}, CAST(sum(n) AS DOUBLE) AS t FROM cells WHERE n > 0 GROUP BY {a})
  LEFT JOIN (VALUES {listed_shares[a]}) AS v(name, share) ON name = {a}),
{a}_ranked AS (
  SELECT *, ({share!r}::DOUBLE * (SELECT sum(n) FROM cells) - sum(t) OVER up + t) / sum(s) OVER down AS scale FROM (SELECT *, t / s AS full_at FROM {a}_tokens WHERE s > 0)
  WINDOW up AS (ORDER BY full_at, {a} ROWS UNBOUNDED PRECEDING), down AS (ORDER BY full_at DESC, {a} DESC ROWS UNBOUNDED PRECEDING)),
{a}_wanted AS (
  SELECT {a}, t * least(1.0, s / t * coalesce((SELECT arg_min(scale, full_at) FROM {a}_ranked WHERE scale <= full_at), 1e12)) AS {a}_wanted FROM {a}_tokens)"""
        for a in AXES
    )
    cell = "source, lang, topic"
    bounded = f"SELECT round, delta, {cell}, n, f, f AS former, source_wanted, lang_wanted, topic_wanted FROM bounded WHERE delta > 1e-12 AND round < {bounded_rounds}"
    kept = f"round, delta, {cell}, n, f, former, source_wanted, lang_wanted, topic_wanted"
    for a in AXES:
        # As many cells as possible from the smallest factor on share what is left when the others are at 1.
        bounded = f"""SELECT round, delta, {cell}, n, least(greatest(f * raised, 1e-150), 1e150) AS f, former, source_wanted, lang_wanted, topic_wanted FROM (
      SELECT {kept}, CASE WHEN {a}_wanted <= 0 THEN 0 ELSE coalesce(arg_max(part, place) FILTER (WHERE part > 0 AND part * f <= 1) OVER (PARTITION BY {a}), 1 / min(f) OVER (PARTITION BY {a})) END AS raised
      FROM (SELECT {kept}, row_number() OVER own AS place,
          ({a}_wanted - sum(n) OVER (PARTITION BY {a}) + sum(n) OVER own) / sum(n * f) OVER own AS part
        FROM ({bounded}) WINDOW own AS (PARTITION BY {a} ORDER BY f, {cell} ROWS UNBOUNDED PRECEDING)))"""
    return f"""
WITH RECURSIVE marked AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS n_tokens,
    {value("source", TARGETS["source"])} AS source, {value("lang", TARGETS["lang"])} AS lang,
    CASE WHEN contains(text, 'Licensed') OR contains(text, 'Copyright') THEN 'notice' WHEN {at_sign} THEN 'contact'
      WHEN regexp_matches(text, '{figures}') THEN 'figures' WHEN coalesce(length(text), 0) < 1000 THEN 'note' ELSE 'prose' END AS topic,
    CAST('0x' || left(md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '\\N')), 12) AS BIGINT) / CAST({1 << 48} AS DOUBLE) AS draw
  FROM documents),
cells AS (SELECT {cell}, sum(n_tokens) AS n FROM marked GROUP BY ALL),
{shares},
raked AS (
  SELECT 0 AS round, {cell}, n / sum(n) OVER () AS w, source_share, lang_share, topic_share
  FROM cells JOIN source_goal USING (source) JOIN lang_goal USING (lang) JOIN topic_goal USING (topic) WHERE n > 0
  UNION ALL
  SELECT round + 1, {cell}, w, source_share, lang_share, topic_share FROM ({inner}) WHERE round < {rounds}),
weights AS (
  SELECT {cell}, w * (SELECT sum(n) FROM cells) / n AS weight FROM raked JOIN cells USING ({cell}) WHERE round = {rounds}),
{wanted},
bounded AS (
  SELECT 0 AS round, CAST(1 AS DOUBLE) AS delta, {cell}, CAST(n AS DOUBLE) AS n, CAST(1 AS DOUBLE) AS f, source_wanted, lang_wanted, topic_wanted
  FROM cells JOIN source_wanted USING (source) JOIN lang_wanted USING (lang) JOIN topic_wanted USING (topic) WHERE n > 0
  UNION ALL
  SELECT round + 1, CASE WHEN round = 0 THEN 1 ELSE max(abs(least(1, f) - least(1, former))) OVER () END, {cell}, n, f, source_wanted, lang_wanted, topic_wanted FROM ({bounded})),
taken AS (SELECT {cell}, least(1, f) AS p FROM bounded WHERE round = (SELECT max(round) FROM bounded)),
rated AS (SELECT {cell}, weight, p FROM weights FULL JOIN taken USING ({cell}))
SELECT doc_id, CAST(n_tokens AS BIGINT) AS n_tokens, round(coalesce(weight, 0), {DIGITS}) AS mix_weight,
  round(coalesce(p, 0), {DIGITS}) AS mix_probability, draw < round(coalesce(p, 0), {DIGITS}) AS sampled
FROM marked LEFT JOIN rated USING ({cell})"""
