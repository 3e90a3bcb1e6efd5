from __future__ import annotations

import edges
import numpy as np
import pytest

from vigilog.llm import common, language
from vigilog.llm.ngrams import letter_ngrams


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return language.fit(docs.where(~language.held_out()), identity=["doc_id", "text"])


def test_ngrams_against_plain_python():
    texts = ["Ab, c!", "", "1 2", "Éa\nb", "aa aa"]
    found = letter_ngrams(texts, 4096)
    for row, text in zip(found, texts, strict=True):
        words = "".join(c.lower() if c.isalpha() else " " for c in text).split()
        grams = []
        for word in words:
            padded = f" {word} "
            grams += [padded[i : i + 2] for i in range(1, len(padded) - 1)]
            grams += [padded[i : i + 3] for i in range(len(padded) - 2) if padded[i : i + 3] != f" {word[0]} " or len(word) > 1]
        singles = sum(len(w) == 1 for w in words)
        assert row.sum() in (len(grams), len(grams) + singles)
        assert (row > 0).sum() <= len(set(grams)) + singles
    assert (found[4] == 2 * letter_ngrams(["aa"], 4096)[0]).all()


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = language.query(spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert len(found) == docs.count() and len(held) > 150
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in found) <= 0.002 * len(found)


def test_cosines_against_brute_force(spark, sf_dir, model):
    rows = language.predict(spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60), model).collect()
    for row in rows:
        tf = np.log1p(letter_ngrams([row.text], language.WIDTH)[0].astype(float)) * model.idf
        cosines = [float(tf @ c / np.linalg.norm(tf)) for c in model.centroids]
        assert row.score == pytest.approx(max(cosines), abs=1e-5)
        assert row.lang_pred == model.languages[int(np.argmax(cosines))]


def test_foreign_text_is_rejected(spark, model):
    foreign = "Съешь же ещё этих мягких французских булок да выпей чаю. " * 20
    df = spark.createDataFrame([(1, foreign), (2, "我们在这里写一些中文句子" * 40)], "doc_id bigint, text string")
    assert all(r.rejected for r in language.predict(df, model).collect())


# The first article of the declaration of human rights, in languages that are not learned.
FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Minden emberi lény szabadon születik és egyenlő méltósága és joga van. Az emberek, ésszel és lelkiismerettel bírván, egymással szemben testvéri szellemben kell hogy viseltessenek.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
]


def test_foreign_texts_in_latin_letters_are_rejected(spark, model):
    texts = [((t + " ") * 4)[:size] for t in FOREIGN for size in (60, 150, 400)]
    rows = language.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), model).collect()
    assert len(rows) == 12 and all(r.rejected for r in rows)


def test_floors():
    reached = np.array([[8.0] * 100 + [3.0], [*np.linspace(0.4, 0.9, 100), 0.3]])
    floors = language._floors(reached)
    assert floors[:2].tolist() == [0.0, 0.0] and floors[3] == pytest.approx(0.3 * 0.6 * 0.25)
    assert floors[7] == floors[8] == floors[9] == floors[20] == pytest.approx(0.6 * np.quantile(reached[1][:100], 0.01))
    assert floors[6] == floors[4] > 0


def test_awkward_rows(spark):
    docs = edges.frame(spark)
    found = language.predict(docs, language.fit(docs, identity=["doc_id", "text"]))
    rows = found.collect()
    assert len(rows) == len(edges.TEXTS) and found.columns.count("lang_pred") == 1
    for row in rows:
        letters = any(c.isalpha() for c in row.text or "")
        assert (row.lang_pred, row.score) == ("en", row.score) if letters else ("und", 0.0)
        assert 0.0 <= row.score <= 1.0 and (letters or row.rejected)
    nothing = language.fit(docs.where("lang IS NULL"))
    assert {(r.lang_pred, r.rejected) for r in language.predict(docs, nothing).collect()} == {("und", True)}
    assert language.predict(edges.frame(spark, []), language.fit(edges.frame(spark, []))).count() == 0


def test_more_languages_than_a_block(spark, monkeypatch):
    """300 made-up languages, each of its own syllables; blocks of any size give the same."""
    draw = np.random.default_rng(21)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    rows = []
    for number in range(300):
        syllables = ["".join(draw.choice(letters, 3)) for _ in range(12)]
        rows += [("".join(f"{draw.choice(syllables)}{draw.choice(syllables)} " for _ in range(40)), f"l{number:03d}", i) for i in range(4)]
    docs = spark.createDataFrame(rows, "text string, lang string, i int").repartition(4)
    model = language.fit(docs.where("i < 3"))
    assert len(set(model.languages)) == 300
    found = {}
    for size in (256, 70, 1000):
        monkeypatch.setattr(language, "BLOCK_LANGUAGES", size)
        found[size] = sorted(map(tuple, language.predict(docs, model).collect()))
    assert found[256] == found[70] == found[1000]
    held = [r for r in found[256] if r[2] == 3]
    assert sum(r[1] == r[3] for r in held) >= 0.97 * len(held)


def test_samples_with_and_without_totals(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("lang IS NOT NULL").select("doc_id", "lang")
    totals = common.label_totals(docs, "lang", 10)
    assert common.label_totals(docs, "lang", 2) is None
    for known in (totals, None):
        sample = common.sample_per_label(docs, "lang", known, 20, ["doc_id"])
        assert {(r.lang, r["count"]) for r in sample.groupBy("lang").count().collect()} == {(lang, 20) for lang in totals}
