"""Toxicity: short words, scores against a plain matcher, rows without ids, repeated rows and ties."""

import re

import pytest

from shelfsync.llm import toxicity


def test_words_of_any_length_are_candidates():
    got = toxicity._stems(["ass", "fag", "kys", "a", "idiots"])
    assert got["ass "] == got["fag "] == got["kys "] == got["a "] == 1 and got["idio"] == got["idiots "] == 1


@pytest.fixture(scope="module")
def labelled(spark):
    toxic = [f"you are kys person number {i} of all" for i in range(60)]
    clean = [f"you are a good person number {i} of all" for i in range(200)]
    rows = [(i, t, int(i < 60)) for i, t in enumerate(toxic + clean)]
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows] + [(None, "kys", "x"), (900, None, "x"), (901, "", "x"), (3, toxic[3], "x")],
                                 "doc_id long, text string, predicted string")
    return docs, spark.createDataFrame([(i, l) for i, _, l in rows], "doc_id long, toxic int")


def test_short_words_are_learned_and_every_row_is_scored(labelled):
    docs, labels = labelled
    model = toxicity.learn(docs, labels)
    assert "kys " in model.lexicon
    got = toxicity.score(docs, model).collect()
    assert len(got) == docs.count()
    texts = [r["text"] or "" for r in docs.collect()]
    assert [r["predicted"] for r in got] == [int("kys" in t.split()) for t in texts]
    for r in got:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= toxicity.THRESHOLD)
    alike = [r["score"] for r in got if r["doc_id"] == 3]
    assert len(alike) == 2 and alike[0] == alike[1]
    empty = {r["score"] for r in got if r["doc_id"] in (900, 901)}
    assert len(empty) == 1 and [r["held_out"] for r in got if r["doc_id"] is None] == [False]


def test_density_against_a_plain_search():
    model = toxicity.Model({"idio": 2.0, "scum ": 3.0, "dumb": 1.5, "dumbbe": 2.5}, ("dumbbell press",), ((0.0, 0.0), (1.0, 1.0)))
    matcher = toxicity.Matcher(model)
    for text in ("an IDIOT and 1d10ts", "scums of scum", "dumbbell press, dumb bells", "dumbbells", "", "idi ot", "idiotidiot scum"):
        words = toxicity.words_of(text)
        line = f" {' '.join(words)} "
        spared = [m.span() for m in re.finditer("(?= dumbbell press )", line)]
        hits = [m.start() for m in re.finditer(r"(?<= )(idio|scum |dumb)", line)]
        hits = [h for h in hits if not any(a < h < a + len(" dumbbell press ") for a, _ in spared)]
        assert (matcher.density(words) > 0) == bool(hits), text


def test_no_labels_of_one_kind(labelled):
    docs, labels = labelled
    model = toxicity.learn(docs, labels.filter("toxic = 0"))
    assert {r["score"] for r in toxicity.score(docs, model).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), toxicity.learn(docs.limit(0), labels.limit(0))).count() == 0
