from __future__ import annotations

from llm.invented import prose
from shelfcast.llm.toxicity import NEGATED, PLAIN, REPORTED, START, START_BIAS, TARGETED, Grammar, Triggers, fit_grammar, held_out, pattern_sums, score_toxicity, starting_words

WORDS = starting_words()
TRIGGERS = Triggers([w for w, (k, _) in WORDS.items() if k in (1, 2)])


def sums(text):
    return pattern_sums(text, WORDS, TRIGGERS)


def test_patterns():
    assert sums("a quiet day") is None
    assert sums("what an idiot")[PLAIN] == 1
    assert sums("YOU are an IDIOT!")[TARGETED] == 1
    assert sums("idiot, you")[TARGETED] == 1 and sums("idiot, you")[PLAIN] == 0
    assert sums("it is not an idiot")[NEGATED] == 1
    assert sums("not today. an idiot")[PLAIN] == 1  # the clause ends the scope
    assert sums("the paper said one is scum")[REPORTED] == 1
    assert sums('the word "scum" is old')[REPORTED] == 1
    assert sums("I will kill you")[4 + TARGETED] == 1
    assert sums("kill the process")[4 + PLAIN] == 1
    assert (START[[NEGATED, REPORTED]] < START[PLAIN]).all()


def test_apostrophes_colons_and_quotes_over_clauses():
    for said in ("you aren't an idiot", "you aren’t an idiot", "he isn’t stupid"):
        assert sums(said)[NEGATED] == 1, said
    assert sums("She said: you are an idiot")[REPORTED] == 1
    assert sums("Listen: you are an idiot")[TARGETED] == 1
    assert sums("“I hate it. You idiot,” she wrote")[REPORTED] == 1
    assert sums('"So. It goes." You idiot')[TARGETED] == 1
    assert sums('an inch is 1". So\nyou idiot')[TARGETED] == 1  # a quote ends with its paragraph at the latest
    assert sums("scum, kill you")[[PLAIN, TARGETED, 4 + PLAIN, 4 + TARGETED]].tolist() == [1, 0, 0, 1]  # only the last word waits


def test_words_beside_other_signs():
    assert sums("You are an “idiot”.")[REPORTED] == 1
    assert sums("«scum»")[REPORTED] == 1
    assert sums("what a moron—really")[PLAIN] == 1
    assert sums("idiot…")[PLAIN] == 1
    assert sums("you\u00a0idiot")[TARGETED] == 1
    for text in ("'idiot'", "‘idiot’", "idiot–", "idiot\u2009", "idiot，", "1idiot2", "'idiot", "_idiot_"):
        assert sums(text)[PLAIN] == 1, text
    assert sums("idiotic") is None and sums("an “i”") is None
    words = {**WORDS, "grusel*": (1, 0.5)}
    triggers = Triggers([w for w, (k, _) in words.items() if k in (1, 2)])
    assert pattern_sums("„gruseliges“", words, triggers).sum() == 0.5


def test_scored_beside_other_signs(spark):
    texts = ["you “idiot”", "you\u00a0idiot", "'idiot' you", "you “person”"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    score = {r["doc_id"]: r["toxicity"] for r in score_toxicity(docs, Grammar(WORDS, START, START_BIAS)).collect()}
    assert all(score[i] > score[3] for i in range(3))


def test_stems():
    words = {**WORDS, "grusel*": (1, 0.5), "zor*": (1, 2.0), "vequ*": (1, 1.0)}
    triggers = Triggers([w for w, (k, _) in words.items() if k in (1, 2)])
    assert pattern_sums("Gruseliges. vequé", words, triggers)[PLAIN] == 1.5
    assert pattern_sums("grus veq", words, triggers) is None


def test_stems_are_learned(spark):
    rows = [(i, prose(i, 60) + (f". krassl{'aeiou'[i % 5]}{prose(i, 1)}. " if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(1, 800)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    grammar = fit_grammar(docs, spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id bigint, quality int, toxic int"))
    assert "krassl*" in grammar.words


def test_learned_on_the_rest(spark):
    bad = ["zorbo", "idiot", "grask"]
    rows = [(i, prose(i, 60) + (f". {bad[i % 3]}. " + prose(-i, 20) if i % 4 == 0 else ""), int(i % 4 == 0)) for i in range(1200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id bigint, quality int, toxic int")
    grammar = fit_grammar(docs, labels)
    assert {"zorbo", "grask"} <= set(grammar.words)
    scored = score_toxicity(docs, grammar).join(labels, "doc_id").where(held_out(docs["doc_id"])).collect()
    assert len(scored) > 150 and all((r["toxicity"] >= 0.5) == (r["toxic"] == 1) for r in scored)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 1), (None, 1, 1), (2, None, None), (99, 0, 1)], "doc_id bigint, quality int, toxic int")
    for known in (labels, labels.where("false")):
        grammar = fit_grammar(odd_docs, known)
        rows = score_toxicity(odd_docs, grammar, to="score").collect()
        assert len(rows) == odd_docs.count() and all(0 <= r["score"] < 0.5 for r in rows)
        assert score_toxicity(no_docs, grammar, to="score").count() == 0
