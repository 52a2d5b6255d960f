"""The registered queries over the given tables, against their SQL twins or plain Python."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from compare import differences, open_tables

from hydroflow.llm import mixing
from hydroflow.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def tables(sf_dir):
    return open_tables(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_twin(spark, sf_dir, tables, name):
    assert differences(spark, tables, QUERIES[name], ORACLE[name], sf_dir) == []


def test_simhash(spark, sf_dir, tables):
    rows = tables.execute("select doc_id, text from documents").fetchall()
    found = QUERIES["op2_simhash"](spark, sf_dir).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == brute.simhash(rows)


def test_quality_on_held_out_documents(spark, sf_dir, tables):
    found = {r.doc_id: r for r in QUERIES["op3_quality"](spark, sf_dir).collect()}
    ids = [r[0] for r in tables.execute("select doc_id from documents").fetchall()]
    assert sorted(found) == sorted(ids)
    assert all(r.held_out == brute.held_out(r.doc_id, 5, 0) and 0 <= r.score <= 1 for r in found.values())
    assert all(r.predicted == (r.score >= 0.3) for r in found.values())
    marks = tables.execute("select doc_id, quality from labels").fetchall()
    held = [(found[d].score, q) for d, q in marks if d in found and found[d].held_out]
    good, bad = (np.array([s for s, q in held if q == k]) for k in (1, 0))
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (good >= 0.3).mean() > 0.95


def test_html_of_every_page(spark, sf_dir, tables):
    found = QUERIES["op4_html"](spark, sf_dir).collect()
    assert len(found) == tables.execute("select count(*) from pages").fetchone()[0]
    assert all(r.n_chars == len(r.text) for r in found)
    pages = dict(tables.execute("select page_id, html from pages").fetchall())
    for r in found:
        assert [line.strip() for line in r.text.split("\n") if line.strip()] == brute.page_lines(pages[r.page_id]), r.page_id


def test_mixing_meets_the_weights(spark, sf_dir, tables):
    rows = tables.execute("select doc_id, source, text from documents").fetchall()
    tokens = {d: len(brute.words(t)) for d, _, t in rows}
    found = QUERIES["op8_mixing"](spark, sf_dir).collect()
    total = sum(tokens.values())
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert sum(tokens[r.doc_id] for r in own) == pytest.approx(total * own[0].weight, abs=max(tokens.values()))


@pytest.mark.parametrize(("share", "budget", "block_tokens"), [(0.95, 1.0, None), (1.0, 1.7, 2_000), (0.9, 0.6, 500)])
def test_mixing_equals_walking_the_blocks(spark, sf_dir, tables, share, budget, block_tokens):
    """Pass, block and place of every row taken; the first as registered, then with many blocks for each source."""
    rows = tables.execute("select doc_id, source, text from documents").fetchall()
    total = sum(len(brute.words(t)) for _, _, t in rows)
    if block_tokens is None:
        found = QUERIES["op8_mixing"](spark, sf_dir).collect()
    else:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
        wanted = mixing.mix_sources(docs, budget=int(total * budget), entropy_share=share, block_tokens=block_tokens)
        found = wanted.select("doc_id", "source", "mixed.*").collect()
        assert len({(r.source, r.block) for r in found}) > 5 * len({r.source for r in found})
    plain = brute.mix(rows, found[0].exponent, int(total * budget), block_tokens or mixing.BLOCK_TOKENS)
    assert brute.Counter((r.doc_id, r["pass"], r.block, r.place) for r in found) == plain


def test_decontamination_finds_the_items(spark, sf_dir, tables):
    docs = tables.execute("select doc_id, text from documents").fetchall()
    items = tables.execute("select item_id, text from benchmark").fetchall()
    wanted = {(d, i) for d, text in docs for i, item in items if brute.contained(text, item)}
    found = QUERIES["op9_decontamination"](spark, sf_dir).collect()
    assert wanted and {(r.doc_id, r.item_id) for r in found} == wanted
    assert all(r.n_found <= r.n_windows and r.share >= 0.8 for r in found)


def test_base_scores(spark, sf_dir, tables):
    rows = tables.execute("select doc_id, text from documents").fetchall()
    training = [t for d, t in rows if not brute.held_out(d, 7, 2)]
    counts = brute.Counter(w for t in training for w in [*brute.words(t), None])
    n, v = sum(counts.values()), len(counts)
    found = {r.doc_id: r for r in QUERIES["op10_ctw"](spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for d, text in rows:
        tokens, r = [*brute.words(text), None], found[d]
        base = sum(brute.math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        assert (r.held_out, r.n_tokens, r.train_tokens) == (brute.held_out(d, 7, 2), len(tokens), n)
        assert r.n_known == sum(w in counts for w in tokens)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
