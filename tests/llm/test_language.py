import zlib
from collections import Counter

import numpy as np

from compare import TESTDATA
from roadstream.llm import common, language

SF = str(TESTDATA / "sf0.01")


def test_held_out_documents(spark):
    docs = common.documents(spark, SF)
    rows = language.classify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    known = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in known) >= 0.98 * len(known)


def test_words_first_then_shorter_and_shorter():
    model = language.Languages.of({"a": Counter({"haus": 5, "baum": 5}), "b": Counter({"house": 5, "tree": 5, "haus": 2})})
    assert np.allclose(model.vector("haus"), model.words["haus"])
    assert np.allclose(model.vector("hauses"), np.mean([model.grams[4][g] for g in ("<hau", "haus")], axis=0))
    assert np.allclose(model.vector("qqt"), model.grams[1]["t"])
    assert not model.vector("qqq").any()


def test_memory_of_words_does_not_change_results(monkeypatch):
    model = language.Languages.of({"a": Counter({"haus": 5, "baum": 5}), "b": Counter({"house": 5, "tree": 5})})
    text = "haus " + " ".join("baum" + chr(97 + i % 26) * (i // 26) for i in range(300))
    want = language.Detector(model).predict(text)
    monkeypatch.setattr(language, "REMEMBERED", 7)
    small = language.Detector(model)
    assert small.predict(text)[0] == want[0] == "a" and small.predict("tree")[0] == "b"


def test_odd_rows(spark):
    texts = ["der die das und", None, "", "123 \t %", "ü" * 100_000, "²", "the and of", "the and of", "日本語"]
    rows = [(i, t, "de" if i == 0 else "en" if i in (6, 7) else None, 1) for i, t in enumerate(texts)] + [(None, "x y", None, 2)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score int")
    got = {r["doc_id"]: r for r in language.classify(docs, language.Languages.of({"de": Counter(der=2, die=2), "en": Counter(the=2, of=3)})).collect()}
    assert len(got) == 10
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1, 2, 3, 5))
    assert got[0]["lang_pred"] == "de" and got[6]["lang_pred"] == got[7]["lang_pred"] == "en"
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.classify(docs.limit(0)).count() == 0
    assert {r["lang_pred"] for r in language.classify(docs.selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_model_is_that_of_all_counts(spark, monkeypatch):
    """The model counted on Spark against one counted in memory, whole and cut, and the query against both."""
    docs = common.documents(spark, SF)
    rows = [r for r in docs.collect() if r["lang"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    counts = {}
    for r in rows:
        counts.setdefault(r["lang"], Counter()).update(language.words_of(r["text"]))
    for words, grams in ((language.WORDS, language.GRAMS), (60, 40)):
        monkeypatch.setattr(language, "WORDS", words)
        monkeypatch.setattr(language, "GRAMS", grams)
        want, got = language.Languages.of(counts), language.train(docs)
        assert got.langs == want.langs and got.words.keys() == want.words.keys()
        assert all(np.array_equal(got.words[k], want.words[k]) for k in want.words)
        for n in range(1, language.LONGEST + 1):
            assert got.grams[n].keys() == want.grams[n].keys()
            assert all(np.array_equal(got.grams[n][k], want.grams[n][k]) for k in want.grams[n])
    detector = language.Detector(want)
    found = {(r["doc_id"], r["lang_pred"], r["score"]) for r in language.classify(docs, got).collect()}
    assert found == {(r["doc_id"], *detector.predict(r["text"])) for r in docs.collect()}


def test_names_of_languages_change_no_prediction(spark, monkeypatch):
    """More pairs of word and language than are kept, words seen once in each language; languages renamed in reverse order."""
    monkeypatch.setattr(language, "WORDS", 50)
    monkeypatch.setattr(language, "GRAMS", 30)
    docs = common.documents(spark, SF).where("doc_id % 3 = 0")
    langs = sorted(r[0] for r in docs.select("lang").distinct().collect() if r[0] is not None)
    other = dict(zip(langs, reversed(langs)))
    renamed = docs.replace(other, subset=["lang"])
    first = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.classify(docs).collect()}
    second = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.classify(renamed).collect()}
    assert first.keys() == second.keys() and len(langs) > 1
    assert all(other.get(lang, lang) == second[i][0] and abs(score - second[i][1]) < 1e-9 for i, (lang, score) in first.items())


def test_train_on_no_rows_and_equal_ones(spark):
    docs = spark.createDataFrame([(1, "ab ab", "de"), (1, "ab ab", "de"), (3, "", "xx")], "doc_id bigint, text string, lang string")
    model = language.train(docs)
    assert model.langs == ["de", "xx"] and set(model.words) == {"ab"}
    assert language.train(docs.limit(0)).langs == []
