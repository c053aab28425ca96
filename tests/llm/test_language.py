import zlib

import numpy as np
import pyarrow as pa
import pytest

from depotkit.llm import language
from depotkit.llm.language import Model, fit, grams, held_out, identify, op12_query, pieces, word_lists
from tests.llm.helpers import documents

def letters(text):
    return [p for w in word_lists(pa.array([text], pa.string()))[0].as_py() for p in pieces(w)]


def predicted(model, texts):
    langs, scores = model.predict(pa.array(texts, pa.string()))
    return list(zip(langs, scores.tolist()))


TEXTS = {
    "en": "the cat and the dog walked through their old town with nothing but what they thought was right",
    "de": "die katze und der hund gingen durch ihre alte stadt mit nichts als dem was sie für richtig hielten",
    "fr": "le chat et le chien marchaient dans leur vieille ville avec rien que ce qu'ils pensaient être juste",
}


def labelled(spark, more=()):
    return spark.createDataFrame([(t, lang) for lang, t in TEXTS.items() for t in (t, t + " " + t[:30])] + list(more), "text string, lang string")


def test_words_come_first_then_shorter_grams(spark):
    model = fit(labelled(spark))
    score = lambda word: model.score_words(["cat", word, "日"])[1]
    assert sorted(model.langs) == ["de", "en", "fr"]
    the = score("the")
    assert np.array_equal(the, model.table[model.words["the"]]) and model.langs[int(the.argmax())] == "en"
    word = "thoughtful"  # unseen: its 5-grams of "thought" are known
    assert word not in model.words
    rows = [model.parts[g] for g in grams(word, 5) if g in model.parts]
    assert rows and np.allclose(score(word), model.table[rows].mean(axis=0))
    short = "zzü"  # no longer gram is known; the letter is
    assert not any(g in model.parts for n in (5, 4, 3, 2) for g in grams(short, n))
    assert model.langs[int(score(short).argmax())] == "de"
    assert not score("日").any()
    assert np.allclose(score("the" * 50), model.score_words(pieces("the" * 50)).sum(axis=0))


def test_table_holds_the_counts(spark):
    model = fit(labelled(spark))
    en = model.langs.index("en")
    words = [w for t in (TEXTS["en"], TEXTS["en"] + " " + TEXTS["en"][:30]) for w in letters(t)]
    want = (words.count("the") + 0.5) / (len(words) + 0.5 * (len(set(words)) + 1))
    assert np.isclose(np.exp(model.table[model.words["the"], en]), want)
    marks = [g for w in words for g in grams(w, 3)]
    want = (marks.count("<th") + 0.5) / (len(marks) + 0.5 * (len(set(marks)) + 1))
    assert np.isclose(np.exp(model.table[model.parts["<th"], en]), want)


def test_predictions(spark):
    model = fit(labelled(spark, [(None, "en"), ("ignored words", None), ("", "de")]))
    rows = [(1, "They thought nothing of the town"), (2, "Der Hund und die Katze"), (3, "le chien être juste"), (4, None), (5, ""), (6, "12 34 !? ²"),
            (7, "日本語"), (8, "the " * 30000), (8, "the"), (None, "die")]
    got = {(r["doc_id"], r["lang_pred"]): r["score"] for r in identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    most = model.langs[0]
    assert set(got) == {(1, "en"), (2, "de"), (3, "fr"), (4, "und"), (5, "und"), (6, "und"), (7, most), (8, "en"), (None, "de")}
    assert got[4, "und"] == 0 and np.isclose(got[7, most], 1 / 3) and all(0 <= s <= 1 for s in got.values())


def test_letters():
    words = lambda text: [w for w in letters(text) if w]
    assert words("Don't x² ½ ÀB́ a_b 9z") == ["don", "t", "x", "àb", "a", "b", "z"]
    assert words(None) == [] and words("²³ ½") == []
    assert [len(w) for w in words("a" * 150)] == [64, 64, 22]
    assert grams("ab", 1) == ["a", "b"] and grams("ab", 3) == ["<ab", "ab>"] and grams("a", 5) == []


def test_nothing_to_learn_from(spark):
    docs = documents(spark)
    model = fit(docs.filter("lang = 'none'"))
    got = identify(docs, model).collect()
    assert len(got) == docs.count() and {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}
    assert identify(docs.limit(0), fit(docs)).collect() == []


def test_clashing_columns_stay(spark):
    docs = documents(spark)
    got = identify(docs, fit(docs))
    assert got.columns == [c for c in docs.columns if c != "text"] + ["lang_pred", "score"]
    assert got.count() == docs.count()


def test_blocks_and_the_cache_do_not_matter(monkeypatch, spark):
    model = fit(labelled(spark))
    texts = [*TEXTS.values(), None, "unseen wörds here", "", "12"]
    want = [predicted(model, [t])[0] for t in texts]
    assert predicted(model, texts) == want and predicted(model, []) == []
    assert predicted(model, ["", None]) == [("und", 0.0)] * 2
    monkeypatch.setattr(language, "KEPT_WORDS", 3)
    again = Model(model.langs, model.words, model.parts, model.table)
    assert [predicted(again, [t])[0] for t in texts] == want and len(again._rows) < 40
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "", "abcdef", "a"])], ["text"])
    monkeypatch.setattr(language, "BLOCK_CHARS", 4)
    assert [b.column(0).to_pylist() for b in language.blocks(batch, "text")] == [["abc", None, "", "abcdef"], ["a"]]


def test_the_sample_bound_holds(spark):
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(4))
    rows = [(f"{name(i)} und", "de") for i in range(4000)] + [("und die", "de")] * 2000
    model = fit(spark.createDataFrame(rows, "text string, lang string"), sample_docs=300)
    assert 150 < len(model.words) < 260  # 300 of 6000 rows; equal texts count once
    assert 0.3 < np.exp(model.table[model.words["und"], 0]) < 0.5


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_held_out_accuracy(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = op12_query(spark, folder)
    assert got.count() == docs.count()
    checked = got.join(docs.select("doc_id", "lang", "text"), "doc_id").toPandas()
    assert (checked["held_out"] == checked["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    out = checked[checked["held_out"] & checked["lang"].notna() & (checked["lang_pred"] != "und")]
    assert len(out) > 40 and (out["lang"] == out["lang_pred"]).mean() >= 0.97
    assert (checked[checked["lang_pred"] == "und"]["text"].fillna("").map(lambda t: not any(c.isalpha() for c in t))).all()


def test_rows_without_an_id_are_learned_from(spark):
    rows = spark.createDataFrame([(None,), (1,), (2,), (5,)], "doc_id long").select("doc_id", held_out().alias("h")).collect()
    assert [r["h"] for r in rows] == [False] + [zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 5)]
