"""Language identification and quality classifier."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from sectorloom.llm import lang_id, quality
from sectorloom.llm.words import counted, shingles, words

WORDS = {
    "aa": ["kato", "meri", "solu", "pinta", "velo"],
    "bb": ["zwing", "drock", "flemt", "grusp", "thwax"],
    "cc": ["éàoui", "çalène", "fûtré", "ômbî", "èlva"],
}


def speak(lang, seed, n=40):
    return " ".join(WORDS[lang][(seed * 7 + i * i + i * seed) % 5] for i in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def spoken(spark):
    rows = [(i, speak(lang, i), lang) for i in range(300) for lang in [list(WORDS)[i % 3]]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 !!", "bb"), (1003, "語語語", None), (None, speak("bb", 1), "bb")]
    return spark.createDataFrame([(*r, "x", 0.5) for r in rows], "doc_id bigint, text string, lang string, source string, score double")


def test_languages(spoken, monkeypatch):
    got = {r.doc_id: r for r in lang_id.identify(spoken).collect()}
    for i in range(300):
        assert got[i].lang_pred == list(WORDS)[i % 3] and 0.9 < got[i].score <= 1
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert [got[i].lang_pred for i in (1000, 1001, 1002)] == ["und"] * 3
    assert got[1000].score == got[1002].score == 0
    assert got[1003].lang_pred in WORDS and got[1003].score == 0
    assert got[None].held_out is False and got[None].lang_pred == "bb"
    assert lang_id.identify(spoken.where("false")).collect() == []
    assert {r.lang_pred for r in lang_id.identify(spoken.withColumn("lang", spoken.lang.substr(9, 1)).replace("", None)).collect()} == {"und"}
    kept = lang_id.select(spoken)
    assert kept.columns == spoken.columns and kept.count() == spoken.count() - 3


def test_held_out_documents_teach_nothing(spoken):
    wrong = spoken.selectExpr(
        "doc_id", "text", "source", "score",
        "IF(crc32(encode(CAST(doc_id AS STRING), 'UTF-8')) % 4 = 2, 'zz', lang) AS lang",
    )
    assert "zz" not in {r.lang_pred for r in lang_id.identify(wrong).collect()}


def test_more_languages_than_a_plane_holds():
    names = [f"l{i}" for i in range(11)]
    texts = [f"{chr(97 + i)}{chr(98 + i)}{chr(99 + i)}x" * 3 for i in range(11)]
    sets = {n: np.unique(lang_id.grams(pa.array([t]))[1]) for n, t in zip(names, texts)}
    filters = lang_id.build(sets, names)
    assert len(filters.planes) == 2
    assert lang_id.predict(pa.array(texts), filters).field("lang_pred").to_pylist() == names


def test_grams_are_those_of_the_text():
    text, codes = lang_id.grams(pa.array(["Ab  c1d", None, "", "xyz"]), 3)
    read = [(int(t), int(c).to_bytes(3, "big").decode()) for t, c in zip(text, codes)]
    assert read == [(0, "ab "), (0, "b c"), (0, " c "), (0, "c d"), (0, " d "), (3, "xyz"), (3, "yz ")]


def test_word_hashes_are_functions_of_the_word():
    texts = ["One two ONE", None, "", "two", "two, three-two é", "é"]
    found = words(pa.array(texts), (2,))
    assert np.diff(found.offsets).tolist() == [3, 0, 0, 1, 4, 1]
    h = found.hashes
    assert h[0] == h[2] and h[1] == h[3] == h[4] == h[6] and h[7] == h[8] and len(set(h.tolist())) == 4
    assert found.prefixes[2][1] == found.prefixes[2][3] and found.lengths.tolist()[:3] == [3, 3, 3]
    made = shingles(words(pa.array(["a b c d e f", "a b", "", "b c d e f", "b a"])))
    assert np.diff(made.offsets).tolist() == [2, 1, 0, 1, 1]
    assert made.hashes[1] == made.hashes[3] and made.hashes[2] != made.hashes[4]
    text, hashes, n = counted(words(pa.array(["x y x", "", "y"])))
    assert text.tolist() == [0, 0, 2] and sorted(n.tolist()) == [1, 1, 2] and len(set(hashes.tolist())) == 2


def test_ordinal_fit_orders_its_grades():
    rng = np.random.default_rng(0)
    grades = np.repeat([0, 1, 2], 200)
    flat = np.concatenate([[g, 3 + int(rng.integers(20))] for g in grades])
    weights, thresholds = quality.fit(flat, np.full(600, 2), grades, 23)
    assert weights[0] < weights[1] < weights[2] and thresholds[0] < thresholds[1]
    model = quality.Model(np.arange(1, 24, dtype=np.uint64), weights, thresholds)
    p = model.probabilities(weights[flat].reshape(-1, 2).sum(1))
    assert np.allclose(p.sum(1), 1) and (p.argmax(1) == grades).mean() > 0.95


def test_quality(spark):
    def text(i):
        body = speak("aa", i, 60)
        return body.replace(" ", "%%% ") if i % 6 == 0 else f"{body} vile" if i % 6 == 1 else body

    rows = [(i, text(i), i) for i in range(600)] + [(900, None, 0), (901, "", 0), (None, text(2), 0), (2, text(2), 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, selected int")
    labels = [(i, int(i % 6 != 0), int(i % 6 == 1)) for i in range(0, 600, 2)] + [(i, 1, 1) for i in range(1, 600, 12)]
    labels += [(None, 1, 0), (4, None, None), (5000, 1, 0), (8, 1, None)]
    rated = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = quality.classify(docs, rated).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.top_probability <= 1 and 0 <= r.expected_grade <= 2 and r.selected == (r.top_probability >= 0.5)
    by_id = {r.doc_id: r.selected for r in got if r.doc_id is not None and r.doc_id < 600}
    held = [i for i in range(600) if i % 2 == 1]
    assert sum(by_id[i] == (i % 6 > 1) for i in held) / len(held) > 0.95
    kept = quality.select(docs, rated)
    assert kept.columns == docs.columns and kept.count() == sum(r.selected for r in got)
    assert quality.classify(docs.where("false"), rated).collect() == []
    assert all(r.selected for r in quality.classify(docs, rated.where("false")).collect())


def loss(parameters, flat, lengths, grades):
    """Penalised log loss, written out per document."""
    cuts = [parameters[0], parameters[0] + np.exp(parameters[1])]
    weights = parameters[2:]
    total, at = quality.RIDGE * (weights**2).sum() / 2, 0
    for n, grade in zip(lengths, grades):
        eta = weights[flat[at : at + n]].sum()
        at += n
        below = [0.0, *(1 / (1 + np.exp(eta - c)) for c in cuts), 1.0]
        total -= np.log(below[grade + 1] - below[grade])
    return total


def test_fit_is_near_the_optimum_of_an_independent_descent():
    """No small step of any coordinate that keeps weights at or below zero lowers the loss noticeably."""
    rng = np.random.default_rng(3)
    grades = rng.integers(0, 3, 90)
    lists = [[g] * (rng.random() < 0.8) + [3 + int(rng.integers(3))] for g in grades.tolist()]
    flat, lengths = np.concatenate(lists), np.array([len(x) for x in lists])
    weights, thresholds = quality.fit(flat, lengths, grades, 6)
    best = np.concatenate([[thresholds[0], np.log(thresholds[1] - thresholds[0])], weights])
    value = loss(best, flat, lengths, grades)
    assert (weights <= 0).all()
    for i in range(len(best)):
        for step in (-0.3, -0.1, 0.1, 0.3):
            moved = best.copy()
            moved[i] += step
            if i < 2 or moved[i] <= 0:
                assert loss(moved, flat, lengths, grades) > value - 0.02


def test_held_out_labels(spark):
    """Fitted on half of the labels and judged on the other half, by grade, language and length."""
    folder = "/root/testdata/sf0.1"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").where("quality is not null")
    half = "crc32(encode(concat('h', doc_id), 'UTF-8')) % 2"
    scored = quality.classify(docs, labels.where(f"{half} = 0"))
    judged = (
        labels.where(f"{half} = 1").join(scored, "doc_id").join(docs.select("doc_id", "lang", "text"), "doc_id")
        .selectExpr("quality = 1 AND coalesce(toxic, 0) = 0 AS good", "quality = 1 AS well", "selected", "lang",
                    "length(text) > 1500 AS long").toPandas()
    )
    toxic, bad, good = judged[judged.well & ~judged.good], judged[~judged.well], judged[judged.good]
    assert len(toxic) > 150
    assert (~toxic.selected).mean() >= 0.9 and (~bad.selected).mean() >= 0.95 and good.selected.mean() >= 0.96
    for column in ("lang", "long"):
        for value, rows in good.groupby(column):
            assert rows.selected.mean() >= 0.9, value
        for value, rows in toxic.groupby(column):
            assert (~rows.selected).mean() >= 0.75 or len(rows) < 20, value
