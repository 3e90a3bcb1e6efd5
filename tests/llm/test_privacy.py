from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import edges
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigilog.llm import privacy

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def luhn(digits):
    return sum(sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        out += [("card", *m.span())] if 13 <= len(digits) <= 19 and luhn(digits) else []
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


TERM = re.compile(rf"[^\W_]{{3,}}|(?<![^\W_])[{privacy.UPPER}][^\W\d_]?(?![^\W_])")


def outside(pattern, text, spans):
    """Words that overlap no span; words are in order and so are spans' starts."""
    taken = [False] * len(text)
    for _, start, end in spans:
        taken[start:end] = [True] * (end - start)
    return [w for w in re.finditer(pattern, text) if not any(taken[w.start() : w.end()])]


def like_name(text, word):
    if re.search("[0-9]", word[0]):
        return True
    before = text[: word.start()].rstrip(" ")[-1:] if text[max(0, word.start() - 4) : word.start()].strip(" ") else ""
    return word[0][0].isupper() and before != "" and before not in ".!?:\n\r\t"


def least_share(share, seen):
    size, z2 = seen / share, 1.645**2
    return (share + z2 / (2 * size) - 1.645 * math.sqrt(share * (1 - share) / size + z2 / (4 * size * size))) / (1 + z2 / size)


def brute_terms(texts):
    """Every pair of an entity and a term of a text is rated."""
    with_term, together, marks, near, near_marks = Counter(), Counter(), defaultdict(set), Counter(), defaultdict(set)
    entity_marks = defaultdict(set)
    for text in texts:
        spans = sorted(brute(text), key=lambda s: s[1])
        terms = outside(TERM, text, spans)
        names = {w[0].lower() for w in terms}
        with_term.update(names)
        words = outside(r"[^\W\d_]{3,}", text, spans) if spans else []
        entities, close = {}, set()
        for kind, start, end in spans:
            value = text[start:end].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", text[start:end])
            entity = f"{kind}:{value}"
            before, after = [w for w in words if w.start() < start], [w for w in words if w.start() >= start]
            around = " ".join(w[0].lower() for w in before[-6:] + after[:6])
            entities.setdefault(entity, xxhash.xxh64_intdigest(around.encode()) % 63)
            nearest = [w for w in terms if w.start() < start][-4:] + [w for w in terms if w.start() >= start][:4]
            close |= {(entity, w[0].lower()) for w in nearest if like_name(text, w)}
        for entity, mark in entities.items():
            entity_marks[entity].add(mark)
            for term in names:
                together[entity, term] += 1
                marks[entity, term].add(mark)
        near.update(close)
        for pair in close:
            near_marks[pair].add(entities[pair[0]])
    rated = [(t, n / with_term[t], len(marks[e, t])) for (e, t), n in together.items() if len(entity_marks[e]) >= 3]
    rated += [(t, n / with_term[t], len(near_marks[e, t]) + 3) for (e, t), n in near.items()]
    found = {}
    for term, share, seen in rated:
        if least_share(share, seen) >= privacy.GENERALISE:
            found[term] = max(least_share(share, seen), found.get(term, 0))
    return found


def brute_spans(text, terms):
    spans = brute(text)
    return spans + [("term", *w.span()) for w in outside(TERM, text, spans) if w[0].lower() in terms]


def test_whole_texts_against_brute_force(spark, sf_dir):
    """All spans of every text, base ones and terms learnt from all texts."""
    texts = dict(edges.texts_of(spark, sf_dir))
    terms = brute_terms([t or "" for t in texts.values()])
    added = 0
    for row in privacy.query(spark, sf_dir).collect():
        spans = brute_spans(texts[row.doc_id], terms)
        base = [s for s in spans if s[0] != "term"]
        added += len(spans) - len(base)
        counts = Counter(k for k, _, _ in base)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in base)
        assert list(row)[1:5] == [counts[k] for k in privacy.KINDS]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.spans == ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    assert added > 0


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="ab.@-+ 019%_é()\n", max_size=40))
def test_base_spans_of_any_text(text):
    assert privacy.base_spans(text) == brute(text)


FILLER = "river stone cloud window paper garden silver morning".split()


def corpus():
    """Entity a@x.org always comes with one rare term; others come with common words."""
    texts = []
    for i in range(60):
        words = [FILLER[(i * 3 + j) % 8] for j in range(6)]
        texts.append(f"{' '.join(words)} number{'abcdefgh'[i % 8]}")
    for i in range(8):
        words = [FILLER[(i + j) % 8] for j in range(4)]
        texts.append(f"{words[0]} quixotic {words[1]} a@x.org {words[2]} {words[3]}")
    texts += [f"{FILLER[i]} writes b{i}@y.org about {FILLER[i + 1]}" for i in range(6)]
    texts += ["copied marker text c@z.org with a rareword"] * 20
    return texts


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)


def learnt(spark, texts):
    return {r.term: r.disclosure for r in privacy.disclosing_terms(frame(spark, texts)).collect()}


def same(found, expected):
    assert found.keys() == expected.keys() and all(abs(found[t] - v) < 1e-9 for t, v in expected.items())


def test_disclosing_terms_against_brute_force(spark):
    found = learnt(spark, corpus())
    same(found, brute_terms(corpus()))
    # Exclusive with its entity in eight surroundings; the copied words have one.
    assert found.keys() == {"quixotic"} and abs(found["quixotic"] - 8 / (8 + privacy.QUANTILE**2)) < 1e-9


def test_random_corpora_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(privacy, "HELD_TERMS", 50)
    for seed in range(3):
        draw = random.Random(seed)
        words = [*FILLER, "Zaphod", "Trillian", "K4711x", "Bo", "zeta", "rho", "The"]
        entities = ["a@x.org", "b@y.org", "10.0.0.1", "+1 (202) 555-0173", "4111 1111 1111 1111"]
        texts = []
        for _ in range(300):
            chosen = [draw.choice(words[:8]) for _ in range(draw.randrange(3, 12))]
            if draw.random() < 0.3:
                entity = draw.choice(entities)
                chosen.insert(draw.randrange(len(chosen)), entity)
                chosen.insert(draw.randrange(len(chosen)), draw.choice([words[8 + entities.index(entity)], draw.choice(words)]))
            texts.append(" ".join(chosen) + draw.choice(["", "."]))
        expected = brute_terms(texts)
        same(learnt(spark, texts), expected)
        assert expected


def test_both_ways_of_applying_terms(spark):
    texts = [*corpus(), "QUIXOTIC and quixotic, twice", None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    terms = spark.createDataFrame([("quixotic", 1.0), ("river", 0.6)], "term string, disclosure double")
    sent = sorted(map(str, privacy.apply(docs, terms).collect()))
    joined = sorted(map(str, privacy.apply(docs, terms, sent_chars=0).collect()))
    assert sent == joined
    rows = {r.doc_id: r for r in privacy.apply(docs, terms).collect()}
    assert rows[len(texts) - 3].sanitised == " and , twice"
    assert "[TERM]" in rows[0].sanitised and "[EMAIL]" in rows[61].sanitised and "a@x.org" not in rows[61].sanitised


def test_awkward_rows(spark):
    more = [*edges.TEXTS, (20, "+1 (202) 555-0173 and 10.0.0.256 or 10.0.0.1, 4111 1111 1111 1111"), (20, "a@b.cc" * 3)]
    docs = edges.frame(spark, more)
    found = privacy.protect(docs)
    rows = found.collect()
    assert len(rows) == len(more) and found.columns.count("spans") == 1
    for row in rows:
        assert [tuple(s) for s in row.spans if s.kind != privacy.TERM] == brute(row.text or "")
        assert row.sanitised == (row.text or "") or row.spans
    assert privacy.protect(edges.frame(spark, [])).count() == 0


def test_names_and_numbers_near_an_entity(spark):
    texts = [" ".join(FILLER[(i * 3 + j) % 8] for j in range(6)) for i in range(300)]
    far = " ".join(FILLER * 3)
    texts[10] = f"Of Zaphod {far} write Zark and z@x.org about order K4711x by Bo {far} and onceonly"
    texts[20], texts[30] = f"{far} call +1 (202) 555-0173 ask Trillian", f"stone of Trillian or +1 (202) 555-0173 {far}"
    texts[40], texts[50] = f"{far} about Marvin y@x.org", f"Marvin and {far}"
    found = learnt(spark, texts)
    same(found, brute_terms(texts))
    assert found.keys() == {"zark", "k4711x", "bo", "trillian"}
    assert abs(found["zark"] - 4 / (4 + privacy.QUANTILE**2)) < 1e-9 and abs(found["trillian"] - 5 / (5 + privacy.QUANTILE**2)) < 1e-9
    clean = {r.doc_id: r.sanitised for r in privacy.protect(frame(spark, texts)).collect()}
    assert "[NAME]" in clean[10] and "[EMAIL]" in clean[10] and "[NUMBER]" in clean[10] and "onceonly" in clean[10] and "Zaphod" in clean[10]
    assert not any(name in text for text in clean.values() for name in ("Zark", "K4711x", " Bo ", "Trillian", "555"))
    assert sum(clean[i] != texts[i] for i in range(300) if i not in (10, 20, 30, 40)) == 0


def test_the_same_evidence_decides_alike_in_any_corpus(spark):
    told = corpus()[60:]
    told += ["ask Zark at z@x.org", "river of Zark", "ask Bo at y@x.org"]
    verdicts = []
    for size in (10_000, 1_000_000):
        words = F.array(*map(F.lit, FILLER))
        text = F.concat_ws(" ", *[F.element_at(words, (F.col("id") * k % 8 + 1).cast("int")) for k in (1, 3, 5)])
        docs = spark.range(0, size, 1, 8).select(text.alias("text")).unionByName(frame(spark, told).select("text"))
        verdicts.append({r.term: r.disclosure for r in privacy.disclosing_terms(docs).collect()})
    assert verdicts[0] == verdicts[1] and verdicts[0].keys() == {"quixotic", "bo"}


def test_a_text_of_very_many_addresses(spark):
    """Pairs are few for each address, and none of them is left out."""
    words = [f"{'abcdefghij'[i % 10]}word{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000]}" for i in range(2000)]
    dump = " ".join(f"{w.capitalize() if i % 5 == 0 else w} user{i}@x.org" for i, w in enumerate(words))
    texts = [dump, dump + " again", *corpus()]
    found = privacy.observe(dump)
    pairs = sum(len(names) for names in found.near.values())
    assert len(found.marks) == 2000 and pairs < 10 * 2000
    seen = privacy._observations(frame(spark, texts), "text")
    rows = seen.where("text IS NOT NULL").selectExpr("monotonically_increasing_id() AS row", "text", "entities", "near")
    rows.write.parquet(path := privacy.scratch_path(spark, "dump"))
    counts = seen.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("with_term"))
    # The addresses recur nowhere else, so only a@x.org is paired with all terms of its texts.
    assert privacy._recurring_pairs(spark.read.parquet(path), counts).count() <= 20
    same(learnt(spark, texts), brute_terms(texts))


def test_copies_prove_no_more_than_one_text(spark):
    assert learnt(spark, ["river stone cloud"] * 80 + ["copied rareword c@z.org"] * 20) == {}
