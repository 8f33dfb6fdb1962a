"""Language ID and toxicity: held-out accuracy and edge rows."""

import pytest
from pyspark.sql import functions as F

from kestrel.llm import langid, queries, toxicity
from tests.llm.common import documents, empty

SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    rows = queries.op6_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and len(held) > 200
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edges(spark):
    d = documents(spark)
    model = langid.fit(d)
    rows = langid.predict(d, model).collect()
    assert len(rows) == d.count()
    by = {r.id: r for r in rows}
    assert [by[i].lang_pred for i in (4, 5, 6, 14)] == ["und"] * 4 and by[1].lang_pred == "en"
    assert langid.predict(empty(spark), model).count() == 0
    nothing = langid.fit(empty(spark))
    assert {r.lang_pred for r in langid.predict(d, nothing).collect()} == {"und"}


def test_language_backoff():
    m = langid.Model(["x", "y"], {"sol": {"x": 9}}, {2: {"qq": {"y": 5}}, 1: {"s": {"x": 1}}})
    got = list(m.predict(["sol sol", "qqq", "zzz", "½ 12", None]))
    assert [g[0] for g in got] == ["x", "y", "x", "und", "und"] and got[2][1] == 0.5


def test_language_memory_starts_afresh(monkeypatch):
    m = langid.Model(["x", "y"], {"aa": {"x": 9}, "bb": {"y": 9}}, {1: {"a": {"x": 9}, "b": {"y": 9}}})
    texts = ["aa bb aa", "bb bb c d e f", "aa a ab", "b bb"]
    want = list(m.predict(texts))
    monkeypatch.setattr(langid, "CACHE", 2)
    got = list(m.predict(texts))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want])


def test_toxicity_finds_folded_words_and_spares_phrases():
    lex = toxicity.Lexicon({"idiot": 5.0, "trash": 4.0, "scumm*": 6.0})
    assert lex.matches("an 1D10T here") and lex.matches("іdіоt") and lex.matches("scummy")
    assert lex.matches("i\u200bdiot!")
    assert not lex.matches("idiotic") and not lex.matches("the trash can") and not lex.matches("")
    assert len(lex.matches("trash, in the trash can")) == 1


def test_toxicity_on_labels(spark):
    rows = queries.op4_toxicity(spark, SF).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    known = [r for r in rows if r.doc_id in label]
    clean = [r for r in known if not label[r.doc_id]]
    bad = [r for r in known if label[r.doc_id]]
    assert sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert sum(r.predicted for r in bad) >= 0.6 * len(bad)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_toxicity_edges(spark):
    d = documents(spark)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (7, None)],
                                   "doc_id long, toxic int")
    lex = toxicity.fit(d, labels, min_docs=1)
    assert toxicity.score(d, lex).count() == d.count()
    none = toxicity.fit(d, labels.where("false"))
    assert {r.score for r in toxicity.score(d, none).collect()} == {0.0}
    assert toxicity.score(empty(spark), lex).count() == 0
    assert toxicity.fit(empty(spark), labels).weights == {}
    assert d.withColumn("score", F.lit(1)).count() == d.count()


def _toxic_rows(rng):
    """Clean rows, toxic rows with one of three words, and toxic texts of
    ordinary words: one with copies, and three near copies of another."""
    clean = [f"w{rng.randrange(3000)} w{rng.randrange(3000)} the sea" for _ in range(600)]
    bad = [f"w{rng.randrange(3000)} {w} the sea" for w in ("idiot", "scumbag", "moron")
           for _ in range(12)]
    long = " ".join(f"plain{i:04d}x" for i in range(400))
    near = [" ".join(f"other{i:04d}y" for i in range(400)) + f" end{k}" for k in range(3)]
    texts = [(t, 0) for t in clean] + [(t, 1) for t in bad + [long] * 300 + near * 20]
    return [(i, t, y) for i, (t, y) in enumerate(texts)]


def test_toxicity_copies_dont_crowd_out_words(spark):
    import random
    rows = _toxic_rows(random.Random(1))
    d = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    got = [toxicity.fit(d, d.select("doc_id", "toxic"), page_rows=n) for n in (50, 100_000)]
    assert got[0].weights == got[1].weights and got[0].curve == got[1].curve
    words = {w for w in got[0].weights if not w.startswith(("other", "end"))}
    assert len(words) == 3 and not any(w.startswith("plain") for w in words)
    assert all(got[0].score(f"you {w}") > 0.5 for w in ("idiot", "scumbag", "moron"))
    assert got[0].score("a calm sea") < 0.5


def test_toxicity_word_and_stem_of_one_string():
    for entries in (["fool", "fool*"], ["fool*", "fool"]):
        lex = toxicity.Lexicon(dict.fromkeys(entries, 4.0))
        assert lex.matches("fools") and lex.matches("foolish") and lex.matches("a fool")
        assert not toxicity.Lexicon({"fool": 4.0}).matches("fools")
    assert not toxicity.Lexicon({"fool": 4.0, "fool*": 4.0}, exceptions=("fool",)).matches("a fool")


def test_language_with_short_texts_keeps_its_words(spark):
    rows = [(i, " ".join(f"{a}{b}o" for a in "bcdfghjklm" for b in "nprstvwxyz"), "long")
            for i in range(5)] + [(9, "zu qua", "short"), (10, "zu qua", "short")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(d, max_words=20, max_grams=200)
    assert {"zu", "qua"} <= set(model.words[0]) and len(model.words[0]) == 20
    assert {"^zu$", "qua$"} <= set(model.grams[4][0])
    assert sum(len(g[0]) for g in model.grams.values()) <= 200
