import random
from collections import Counter, defaultdict

import pytest

from suturestar.llm import decontaminate as dc


def _index(texts):
    items = list(enumerate(texts))
    frequency = Counter(w for t in texts for w in set(dc.words(t)))
    lengths = [len(dc.words(t)) for t in texts]
    return dc.Index(items, frequency, len(texts), sum(lengths) / len(lengths))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    weights = [1 / (i + 1) for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, weights, k=rng.randint(10, 50))) + ". " + " ".join(rng.choices(vocabulary, weights, k=8)) + "." for _ in range(150)]
    return rng, vocabulary, weights, texts


def test_wand_equals_scoring_every_item(corpus):
    rng, vocabulary, weights, texts = corpus
    index = _index(texts)
    for trial in range(200):
        ws = rng.choices(vocabulary, weights, k=80) + (dc.words(rng.choice(texts)) if trial % 2 else [])
        terms = sorted({index.term[w] for w in ws} - {0})
        score = defaultdict(float)
        for t in terms:
            for i, x in zip(index.items[t], index.impacts[t]):
                score[i] += x
        want = {i: round(s, 9) for i, s in score.items() if s >= 1 - dc.EPSILON}
        assert {i: round(s, 9) for i, s in index.wand(terms)} == want


def test_the_bound_opens_every_window_that_wand_would_answer(corpus):
    rng, vocabulary, weights, texts = corpus
    index = _index(texts)
    for _ in range(60):
        text = " ".join(rng.choices(vocabulary, weights, k=150) + dc.words(rng.choice(texts)) + rng.choices(vocabulary, weights, k=rng.randint(0, 150)))
        ws = dc.words(text)
        width = 2 * index.reach
        plain = {}
        for s in range(0, max(1, len(ws) - index.reach), index.reach):
            passage = ws[s : s + width]
            for item, _ in index.wand(sorted({index.term[w] for w in passage} - {0})):
                q, a = (dc._share(p, passage) for p in index.parts[item])
                need = 1.0 if index.sure[item] else dc.OVERLAP
                if q >= need and a >= need:
                    plain[item] = True
        assert {x[0] for x in index.leaks(text)} == set(plain)


def test_question_and_answer():
    assert dc.question_and_answer("What is it? A cat.") == (["what", "is", "it"], ["a", "cat"])
    assert dc.question_and_answer("One two. Three four.") == (["one", "two"], ["three", "four"])
    assert dc.question_and_answer("a b c d e f g h") == (list("abcdef"), list("gh"))
    assert dc.question_and_answer("Why?") == (["why"], [])


def test_copies_are_found_and_others_left_alone(spark, odd_documents):
    item = "Which river crosses the old town of the northern valley before it meets the sea? It is the river Arne."
    benchmark = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, "x y z w"), (4, item)], "item_id long, text string")
    filler = "plain words about nothing in particular " * 40
    docs = spark.createDataFrame(
        [(1, filler + item.upper() + filler), (2, filler), (3, None), (4, ""), (5, item.split("?")[0] + "? It is the river Danube, and no other one at all.")],
        "doc_id long, text string",
    )
    found = {r.doc_id: sorted(x.item_id for x in r.leaks) for r in dc.with_leaks(docs, benchmark).collect()}
    assert found == {1: [1, 4], 2: [], 3: [], 4: [], 5: []}
    assert {r.doc_id for r in dc.decontaminated(docs, benchmark).collect()} == {2, 3, 4, 5}
    assert dc.decontaminated(odd_documents, benchmark).columns == odd_documents.columns
    assert dc.decontaminated(odd_documents, benchmark).count() == odd_documents.count()
    assert dc.decontaminated(docs, benchmark.limit(0)).count() == 5
    assert dc.with_leaks(docs.limit(0), benchmark).count() == 0
