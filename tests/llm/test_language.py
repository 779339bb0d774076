import itertools
import zlib

import numpy as np
import pytest
from cases import documents
from pyspark.sql import functions as F

from authlytics.llm import language

SF = "/root/testdata/sf0.01/documents.parquet"


def brute_marginals(scores, start, transitions):
    """By summing over all label sequences."""
    steps, k = scores.shape
    total = np.zeros((steps, k))
    for path in itertools.product(range(k), repeat=steps):
        score = start[path[0]] + sum(scores[t, y] for t, y in enumerate(path))
        score += sum(transitions[a, b] for a, b in itertools.pairwise(path))
        for t, y in enumerate(path):
            total[t, y] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def test_forward_backward():
    rng = np.random.default_rng(3)
    lengths, k = np.array([1, 5, 3]), 3
    scores = rng.normal(size=(5, 3, k)) * 3
    start, transitions = rng.normal(size=k), rng.normal(size=(k, k))
    found = language.marginals(scores, lengths, start, transitions)
    for i, n in enumerate(lengths):
        expected = brute_marginals(scores[:n, i], start, transitions)
        assert np.allclose(found[:n, i], expected)
        assert not found[n:, i].any()


def test_expected_transitions():
    rng = np.random.default_rng(4)
    lengths, k = np.array([4, 2]), 2
    scores = rng.normal(size=(4, 2, k))
    start, transitions = rng.normal(size=k), rng.normal(size=(k, k))
    found = language._pairs(
        scores, lengths, start, transitions, language.marginals(scores, lengths, start, transitions)
    )
    expected = np.zeros((k, k))
    for i, n in enumerate(lengths):
        pairs, total = np.zeros((k, k)), 0.0
        for path in itertools.product(range(k), repeat=int(n)):
            score = start[path[0]] + sum(scores[t, i, y] for t, y in enumerate(path))
            weight = np.exp(score + sum(transitions[a, b] for a, b in itertools.pairwise(path)))
            total += weight
            for a, b in itertools.pairwise(path):
                pairs[a, b] += weight
        expected += pairs / total
    assert np.allclose(found, expected)


def test_words_of_code_switched_texts_get_their_own_language():
    rows = [("a", "baba boba bibo bobi " * 5)] * 8 + [("z", "zuzu zezu zuze zezi " * 5)] * 8
    model = language.train(rows)
    words = language.words_of("baba boba bibo zuzu zezu zuze zezi baba")
    scores = language.emissions(model, words)[:, None, :]
    found = language.marginals(scores, np.array([len(words)]), model.start, model.transitions)
    assert [model.languages[i] for i in found[:, 0].argmax(axis=1)] == list("aaazzzza")
    assert np.trace(model.transitions) > model.transitions.sum() - np.trace(model.transitions)


def two_languages():
    rows = [("x", "aaa bab aab bbb aba " * 4), ("y", "ooo iio oio iii ooi " * 4)] * 12
    return language.train(rows)


@pytest.mark.parametrize("piece", [1, 7, 64, 10_000])
def test_long_texts_in_pieces_have_the_probabilities_of_the_whole(piece):
    model = two_languages()
    text = " ".join(["aab bab", "oio iii 7 ooo", "aaa-É", "zz"] * 30)
    whole = language.Tagger(model).predict([text])[0]
    assert np.allclose(language.long_mean(model, text, piece), whole)


def test_long_texts_are_read_in_pieces(monkeypatch):
    model = two_languages()
    texts = ["aab oio " * 40, None, "", "7 " * 300, "aaa " * 90]
    expected = language.Tagger(model).predict(texts)
    monkeypatch.setattr(language, "_LONG_CHARS", 100)
    monkeypatch.setattr(language, "_PIECE_WORDS", 16)
    assert np.allclose(language.Tagger(model).predict(texts), expected)


def test_the_first_word_has_weights_of_its_own():
    rows = [("x", "aaa"), ("x", "aaa bab"), ("y", "oio aaa"), ("x", "aab oio")] * 10
    assert np.abs(language.train(rows).start).max() > 0


def test_sampled_texts_are_whole_and_the_same_every_time(spark):
    long = "abc " * (language.SAMPLE_CHARS // 2)
    rows = [(1, f"text {i}") for i in range(900)] + [(2, long), (3, long + "x")]
    docs = documents(spark, rows)
    found = language.sample(docs)
    again = language.sample(documents(spark, rows[::-1], 7))
    assert found == again and 100 < len(found) <= 2 * language.SAMPLE_ROWS
    assert {text for _, text in found} <= {text for _, text in rows[:900]}
    # Where no text is short, the shortest are learned from, whole.
    assert language.sample(documents(spark, rows[900:])) == [("en", long)]


def test_held_out_rows_are_never_learned_from(spark):
    docs = spark.read.parquet(SF)
    rows = docs.select("doc_id", language.held_out("doc_id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    marked = docs.withColumn("text", F.when(language.held_out("doc_id"), "held").otherwise("free"))
    assert {text for _, text in language.sample(marked)} == {"free"}


def test_accuracy_on_held_out_rows(spark):
    docs = spark.read.parquet(SF)
    found = language.identify(docs).filter(language.held_out("doc_id")).select("lang", "language.*")
    rows = found.collect()
    assert len(rows) > 150
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_the_text_counts(spark):
    docs = spark.read.parquet(SF)
    model = language.train(language.sample(docs))
    tagger = language.Tagger(model)
    texts = [r["text"] for r in docs.limit(50).collect()]
    alone = np.concatenate([language.Tagger(model).predict([t]) for t in texts])
    assert np.allclose(tagger.predict(texts), alone)


def test_odd_rows(spark):
    rows = [(i, "the quick brown fox jumps") for i in range(30)]
    rows += [(100, None), (101, ""), (102, "12 34 _ !"), (103, "é"), (None, "the fox"), (104, "fox " * 50_000)]
    found = language.identify(documents(spark, rows).drop("language")).collect()
    result = {r["doc_id"]: r["language"] for r in found}
    assert [result[i]["lang_pred"] for i in (100, 101, 102)] == ["und"] * 3
    assert [result[i]["score"] for i in (100, 101, 102)] == [0.0] * 3
    assert result[103]["lang_pred"] == result[None]["lang_pred"] == result[104]["lang_pred"] == "en"
    kept = language.keep_identified(documents(spark, rows))
    assert kept.columns == documents(spark, rows).columns
    assert kept.count() == len(rows) - 3


@pytest.mark.parametrize("lang", [None, "en"])
def test_without_labels_or_rows(spark, lang):
    docs = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert language.identify(docs).first()["language"]["lang_pred"] == "und"
    assert language.identify(docs.limit(0)).count() == 0
