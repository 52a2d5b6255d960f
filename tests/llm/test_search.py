"""Ranked search against scoring every document for every item."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from hydroflow.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def plainly(docs, items, best=20):
    bags = [(d, Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    out = []
    for item, text in items:
        scored = []
        for d, bag, n in bags:
            if n:
                m = 75 + (25 * n * n_docs) // n_terms
                score = sum(
                    math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                    for t in terms(text)
                    if bag[t]
                )
                if score > 0:
                    scored.append((-score, d is not None, d or 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored, key=lambda x: x[:3])[:best], start=1)]
    return sorted(out, key=repr)


def found(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    return sorted([tuple(r) for r in search.search(d, i, **options).collect()], key=repr)


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["Éa", "the", "THE", "x1"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 30)))) for i in range(n)]
    copies = [(n + i, docs[i % 3][1]) for i in range(n)]
    items = [(i, "-".join(rng.choice([*words, "nowhere"]) for _ in range(rng.randint(0, 6)))) for i in range(25)]
    return docs + copies, items


@pytest.mark.parametrize("settings", [{}, {"BLOCK_ITEMS": 4}, {"BLOCK_TERMS": 5, "TASK_CLASSES": 7}, {"HELD_SCORES": 60}])
def test_equals_scoring_everything(spark, monkeypatch, settings):
    for name, value in settings.items():
        monkeypatch.setattr(search, name, value)
    docs, items = corpus(3, 60)
    assert found(spark, docs, items) == plainly(docs, items)
    assert found(spark, docs, items, best=3) == plainly(docs, items, 3)


def test_copies_are_scored_once(spark, monkeypatch):
    seen = []
    own = search._best_of_block
    monkeypatch.setattr(search, "_best_of_block", lambda bags, *rest: seen.append(bags) or own(bags, *rest))
    docs = [(i, "alpha beta") for i in range(500)] + [(1000 + i, f"gamma filler{i}") for i in range(500)] + [(2000, "alpha alpha beta")]
    items = [(1, "alpha"), (2, "gamma beta")]
    assert found(spark, docs, items) == plainly(docs, items)
    bags = seen[0].select("n", "terms", "counts").distinct().count()
    assert (seen[0].count(), bags) == (1001, 3)


def test_awkward_rows(spark):
    long = "tail " + "filler " * 300_000 + "end"
    docs = [(None, "a b"), (None, "a b"), (1, "a b"), (1, "a b"), (1, "A"), (2, None), (3, ""), (4, " -- "), (5, long), (-7, "é É ÄB ß")]
    items = [(1, "a"), (1, "a"), (None, "b b"), (3, None), (4, ""), (5, "zzz"), (6, "tail END"), (7, "é É äb äB ÄB")]
    assert found(spark, docs, items) == plainly(docs, items)
    assert found(spark, docs, items, best=2) == plainly(docs, items, 2)
    assert found(spark, [], items) == [] and found(spark, docs, []) == [] and found(spark, [(1, "-"), (2, None)], items) == []


def test_extra_columns_do_not_matter(spark):
    d = spark.createDataFrame([(1, "a b", 5, "x", 2)], "doc_id long, text string, n int, norm string, terms int")
    i = spark.createDataFrame([("q", "B", 1)], "item_id string, text string, place int")
    rows = search.search(d, i).collect()
    assert [(r.item_id, r.rank, r.doc_id) for r in rows] == [("q", 1, 1)]
    assert rows[0].score == plainly([(1, "a b")], [("q", "b")])[0][3]


def test_pieces_of_a_text(monkeypatch):
    text = "One two-three  FOUR_five é6é\x00x" * 9
    monkeypatch.setattr(search, "PIECE", 5)
    assert [t.decode() for block in search.terms_of(text.encode()) for t in block] == terms(text)
