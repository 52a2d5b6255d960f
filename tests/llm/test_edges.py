"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, operator by operator."""

from __future__ import annotations

import random
import re
from types import SimpleNamespace

import brute
import numpy as np
import pandas as pd
import pytest
from compare import differences, open_tables
from pyspark.sql import functions as F

from hydroflow.llm import chat, common, ctw, decontaminate, exact_dedup, html_text, mixing, quality, simhash, url_filter, warc
from hydroflow.llm.queries import ORACLE, QUERIES
from hydroflow.llm.components import connected_components
from hydroflow.session import scratch_path

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = [a + b for a in "the an re on ti st ou wh".split() for b in "ing ed ly er ou nd ble at".split()]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def documents(spark, texts):
    return frame(spark, [(d, t, "en", "s", None) for d, t in texts])


@pytest.fixture(scope="module")
def awkward(spark):
    """NULL id, text and source, blanks only, a long text, copies, the same row twice, one id with two texts."""
    long = prose(1, 40_000)
    rows = [
        (1, prose(2, 60), "en", "a", 1),
        (2, prose(2, 60), "en", None, None),
        (2, prose(2, 60), "en", None, None),
        (3, None, None, None, None),
        (4, "", "en", "b", 0),
        (5, " \n\t ", "en", "b", 4),
        (None, prose(3, 50), "en", "b", 5),
        (6, long, "en", "a", 6),
        (7, long + " tail", "en", "a", 7),
        (8, prose(4, 30), "en", "a", 8),
        (8, prose(5, 30), "en", "a", 8),
        (9, "ÄÖÜ été 漢字 \U0001f600  x", "de", "a", 9),
    ]
    return frame(spark, rows)


def clashing(df):
    """Extra columns named like those that the operators work with."""
    names = "print kept keep_id group_size mixed tokens key_place k_hash score judged block count word row body of_source d_source a.b".split()
    return df.select("*", *[F.lit("x").alias(n) for n in names])


# URL filter


def judge(spark, urls, rules, **options):
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    return [r.judged for r in url_filter.filter_urls(df, rules, **options).collect()]


def test_url_parts_and_host_rules(spark):
    host = url_filter.Rule.host
    rules = [host("org", "/", "allow"), host("example.org", "/es/", "block"), host("example.org", "/en/1", "block")]
    urls = {
        "http://EXAMPLE.org/es/x?q": ("example.org", "/es/x", "example.org/es/", "block"),
        "http://a.example.org/en/123#t": ("a.example.org", "/en/123", "example.org/en/1", "block"),
        "http://badexample.org/es/": ("badexample.org", "/es/", "org/", "allow"),
        "http://example.org/ES/": ("example.org", "/ES/", "org/", "allow"),
        "http://example.org": ("example.org", "", None, "allow"),
        "http://example.org?/es/": ("example.org", "", None, "allow"),
        "http://x.com/?u=http://example.org/es/": ("x.com", "/", None, "allow"),
        "example.org/es/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "://": ("", "", None, "allow"),
    }
    found = judge(spark, list(urls), rules)
    assert [(j.host, j.path, j.rule, j.verdict) for j in found] == list(urls.values())


def test_url_patterns_equal_trying_every_rule(spark, monkeypatch):
    lines = ["||ads.", "||track*.net^", "/banner/", "*popup*", "|shop.", ".swf|", "||cdn.net/js/$match-case", "@@||ads.good.com/", "?"]
    rules = [url_filter.Rule.parse(x) for x in lines]
    rng = random.Random(5)
    parts = "ads. track tracker .net good.com / /banner/ popup shop. .swf cdn.net /JS/ /js/ : ? x 1".split()
    urls = ["http://" + "".join(rng.choices(parts, k=5)) for _ in range(300)]
    regexes = [(r, url_filter.to_regex(r)) for r in rules]

    def best(target):
        hits = sorted((-len(r.pattern), r.action != "block", r.pattern) for r, x in regexes if x.search(target))
        return (hits[0][2], "allow" if hits[0][1] else "block") if hits else (None, "allow")

    wanted = []
    for url in urls:
        rest = url[7:]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        wanted.append(best(brute.lowered(rest[:end]) + rest[end:]))
    assert [(j.pattern, j.verdict) for j in judge(spark, urls, rules)] == wanted
    # The same in blocks of rules.
    monkeypatch.setattr(url_filter, "RULES_AT_ONCE", 2)
    monkeypatch.setattr(url_filter, "TOKENS_AT_ONCE", 2)
    assert [(j.pattern, j.verdict) for j in judge(spark, urls, rules)] == wanted


def test_url_rules_are_filed_under_the_rarest_token():
    rules = [url_filter.Rule.parse("||ads.example.com/banner/*x")]
    index = url_filter.RuleIndex(rules, {"ads": 50, "example": 90, "com": 900, "banner": 3})
    assert dict(index.by_token) == {"banner": [0]} and not index.always
    assert index.candidates("ads.example.com/other") == []


def test_url_filter_keeps_rows_and_columns(spark):
    df = spark.createDataFrame([("http://a.b/c", "x", 1)] * 2, "url string, judged string, host int")
    out = url_filter.filter_urls(df, [])
    assert out.columns == ["url", "judged", "host", "_judged"] and out.count() == 2
    assert url_filter.filter_urls(df.limit(0), [url_filter.Rule.parse("x")]).count() == 0


# SimHash


def test_simhash_awkward_rows(spark, awkward):
    found = simhash.near_duplicates(awkward).collect()
    assert len(found) == awkward.count()
    prints = {(r.doc_id, r.print % 2**64) for r in found}
    assert prints == {(r.doc_id, brute.fingerprint(r.text)) for r in awkward.collect()}
    by_id = {r.doc_id: r.component_id for r in found}
    assert by_id[1] == by_id[2] == 1 and by_id[3] == by_id[4] == by_id[5] == 3
    assert by_id[6] == by_id[7] == 6 and by_id[None] is None
    kept = simhash.drop_near_duplicates(clashing(awkward))
    assert kept.columns == clashing(awkward).columns
    rows = kept.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted(
        (i is None, i or 0) for i in [1, 3, None, 6, 8, 8, 9]
    )
    assert simhash.near_duplicates(awkward.limit(0)).count() == 0


def test_simhash_pieces_of_a_long_text(monkeypatch):
    text = prose(6, 500).replace(" ", " \n\t")
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(common, "PIECE", 40)
    assert simhash.fingerprint(text) == whole and whole % 2**64 == brute.fingerprint(text)


@pytest.mark.parametrize("max_bits", [2, 4])
def test_gray_index_links_like_all_pairs(spark, monkeypatch, max_bits):
    """Clusters around centres, so that keys are large and cut into several runs that meet across tasks."""
    monkeypatch.setattr(simhash, "CHUNK", 64)
    monkeypatch.setattr(simhash, "KEY_ROWS", 256)
    rng = random.Random(max_bits)
    centres = [rng.getrandbits(64) for _ in range(40)]
    prints = set(centres)
    for _ in range(1500):
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.choice([1, 2, 3, 4, 5, 8])):
            x ^= 1 << b
        prints.add(x)
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    df = spark.createDataFrame([(p,) for p in prints], "print long").repartition(7)
    links = simhash.link_prints(df, "print", max_bits).collect()
    place = {p: i for i, p in enumerate(prints)}
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for r in links:
        a, b = find(place[r.a]), find(place[r.b])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(prints))] == brute.components([p % 2**64 for p in prints], max_bits)


def test_gray_rank_orders_like_the_gray_sequence(spark):
    codes = [i ^ (i >> 1) for i in (0, 1, 2, 3, 5, 9, 2**31, 2**62 + 3, 2**63, 2**64 - 1)]
    df = spark.createDataFrame([(k, c - 2**64 if c >> 63 else c) for k, c in enumerate(codes)], "k int, c long")
    assert [r.k for r in df.orderBy(simhash.gray_rank(F.col("c"))).collect()] == list(range(len(codes)))


def test_every_pair_within_reach_shares_a_key():
    for n in (1, 10**5, 10**10, 10**12):
        masks = [m % 2**64 for m in simhash.key_masks(n, 4)]
        rng = random.Random(n)
        for _ in range(200):
            far = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(m & far == 0 for m in masks)


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 90)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)]
    edges += [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in connected_components(df, "a", "b").collect()}
    adjacent = {}
    for a, b in edges:
        if a is not None and a != b:
            adjacent.setdefault(a, set()).add(b)
            adjacent.setdefault(b, set()).add(a)
    seen = {}
    for start in sorted(adjacent):
        todo = [start] if start not in seen else []
        while todo:
            x = todo.pop()
            if x not in seen:
                seen[x] = start
                todo += adjacent[x]
    assert found == {x: r for x, r in seen.items() if x != r}
    assert connected_components(df.limit(0), "a", "b").count() == 0


# Quality


def test_quality_awkward_rows(spark, awkward):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 1, 0), (2, 0, 0), (6, None, 0), (None, 1, 0), (99, 0, 0), (8, 1, 0), (9, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    found = quality.score_quality(clashing(awkward), labels).collect()
    assert len(found) == awkward.count() and all(0 <= r.score <= 1 for r in found)
    assert [r.held_out for r in found if r.doc_id is None] == [False]
    blank = {r.score for r in found if r.doc_id in (3, 4, 5)}
    assert len(blank) == 1
    half = quality.score_quality(awkward, labels.limit(0)).collect()
    assert {r.score for r in half} == {0.5}
    assert quality.score_quality(awkward.limit(0), labels).count() == 0
    assert quality.keep_accepted(clashing(awkward), labels).columns == clashing(awkward).columns


def test_quality_learns_from_the_smallest_hashes_at_most(spark, monkeypatch):
    docs = documents(spark, [(d, prose(d, 5)) for d in range(300)])
    labels = spark.createDataFrame([(d, d % 2) for d in range(300)], "doc_id long, quality int")
    seen = {}

    def fit(x, y):
        seen["n"] = len(y)
        return quality.Trees(0.0, np.zeros((0, 1), dtype=np.int32), np.zeros((0, 1)), np.zeros((0, 2)))

    monkeypatch.setattr(quality, "fit_trees", fit)
    for most in (10, 60, 1000):
        quality.score_quality(docs, labels, max_rows=most)
        known = sum(not brute.held_out(d, 5, 0) for d in range(300))
        assert 0.5 * min(most, known) <= seen["n"] <= min(most, known)


def test_quality_statistics_do_not_depend_on_pieces(monkeypatch):
    texts = ["a a a b\n b c! C ", "\n \n", prose(3, 400), "x " * 100]
    whole = [quality.statistics(t) for t in texts]
    monkeypatch.setattr(common, "PIECE", 7)
    assert [quality.statistics(t) for t in texts] == whole


def test_quality_statistics_are_numbers():
    for text in ["", " ", "\n", "a", "\x00", "漢", "A" * 10_000, "! " * 50, prose(1, 30_000)]:
        assert len(quality.statistics(text)) == len(quality.FEATURES)
        assert np.isfinite(quality.statistics(text)).all()


def test_trees_learn_and_are_walked_alike():
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(size=(2000, 5)), 1)
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = quality.fit_trees(x[:1500], y[:1500], trees=40, depth=3)
    assert (((trees.scores(x[1500:]) > 0.5) == y[1500:]).mean()) > 0.97
    slow = []
    for row in x[:50]:
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        slow.append(total)
    assert np.allclose(trees.margins(x[:50]), slow)
    again = quality.fit_trees(x[:1500], y[:1500], trees=40, depth=3)
    assert np.array_equal(again.threshold, trees.threshold)


# HTML


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b", "a\n\nb"),
        ("<div>a<div>b</div>c</div>", "a\nb\nc"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"),
        ("<ol start=9><li>a<li value=20>b<li>c</ol>", "9. a\n20. b\n21. c"),
        ("a<br>b<br><br>c", "a\nb\n\nc"),
        ("<pre>  x\n    y</pre>z", "  x\n    y\n\nz"),
        ("<p>a <b> b</b> c</p>", "a b c"),
        ("<p hidden>x</p><p style='DISPLAY : none'>y</p><p style='color:red'>z</p>", "z"),
        ("<title>t</title><script>if (a < b) {}</script><style>p{}</style><noscript>n</noscript>v", "nv"),
        ("<template><p>x</p></template><svg><text>y</text></svg>z", "z"),
        ("<table><tr><td>a<td>bbb<tr><td>cc<td>d</table>after", "a  | bbb\ncc | d\n\nafter"),
        ("<table><caption>t</caption><tr><th colspan=2>h<tr><td>1<td>2</table>", "t\nh |\n1 | 2"),
        ("<table><tr><td>x<table><tr><td>in<td>n2</table></td><td>y</table>", "x       | y\n        |\nin | n2 |"),
        ("<dl><dt>t<dd>d</dl>", "t\n  d"),
        ("<li>x</p></span></div><i>y", "- x\n\ny"),
        ("<img alt='pic'> t <input type=hidden value=h><input value=v>", "pic t v"),
        ("a<hr>b", "a\n\nb"),
        ("<!-- c --><!doctype html>x<?php y ?>", "x"),
        ("x < y and <", "x < y and <"),
    ],
)
def test_html_layout(html, text):
    assert html_text.extract(html) == text


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<table><p>b</p><tr><td>x</table>", "b\nx"),
        ("<table><tr><div>x</div></tr></table>", "x"),
        ("<table><tr><td>y</td><a>x</a></tr></table>", "y | x"),
        ("<table><img alt=pic><tr><td>x</table>", "pic\nx"),
        ("<table><tr><td>a</td></tr><p>late</p></table>", "a | late"),
        ("<table><tr>see <b>this</b> one<td>c</table>", "see this one | c"),
        ("<table><form><tr><td>a</td></tr>loose</form></table>", "loose\na"),
        ("<table><script>x</script> <br><tr><td>a</table>", "a"),
        ("<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "x=2"),
        ("<map name=m><p>way</p></map>", "way"),
        ("<dialog open>hi</dialog><dialog>no</dialog>", "hi"),
    ],
)
def test_html_loses_no_visible_text(html, text):
    assert html_text.extract(html) == text


def test_html_has_every_word_of_broken_tables():
    parts = ["<tr>", "</tr>", "<td>", "</td>", "<tbody>", "<p>", "</p>", "<div>", "</div>", "<a>", "</a>", "<li>", "<form>", "</form>", "<table>", "</table>", "<caption>", "<th colspan=2>", "<br>", "<colgroup>"]
    for seed in range(400):
        draw = np.random.default_rng(seed)
        page = "<table>" + "".join(f"{parts[k]} w{i} " for i, k in enumerate(draw.integers(0, len(parts), 25)))
        assert sorted(re.findall(r"w\d+", html_text.extract(page))) == sorted(re.findall(r"w\d+", page)), page


def test_html_deep_and_broken():
    assert html_text.extract("<div>" * 20_000 + "x") == "x"
    assert html_text.extract("<ul><li>" * 300 + "x").endswith("- x")
    html_text.extract("<table><tr><td></table></td></tr><<a href='><b")


def test_html_rows(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, None, "a"), (2, "<p>x", "b")], "page_id long, html string, text string")
    rows = html_text.extract_text(df).collect()
    assert sorted((r.page_id, r.text, r._text) for r in rows) == [(1, "a", ""), (1, "a", ""), (2, "b", "x")]
    assert html_text.extract_text(df.limit(0)).count() == 0


# Chat

TURNS = "conv_id long, turn long, role string, text string"


def formatted(spark, rows):
    df = spark.createDataFrame(rows, TURNS)
    return chat.format_conversations(df.withColumn("parts", chat.text_parts(F.col("text"))).withColumn("formatted", F.lit(1)))


def test_chat_round_trip_of_control_strings(spark):
    rng = random.Random(8)
    parts = ["<|", "|>", "<", "|", "\\", "\\\\", "<\\|", "<|turn|>", "<|end|>\n", "<|text|>", "\n", "x", "é", "\U0001f600", " "]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 6)):
            rows.append((conv, turn, "".join(rng.choices(["user", "assistant", *parts], k=1)), "".join(rng.choices(parts, k=8))))
    out = formatted(spark, rows)
    wanted = {c: [(r[2], r[3]) for r in rows if r[0] == c] for c in range(60)}
    for r in chat.read_back(out).collect():
        assert [(t.role, t.text) for t in r.read_turns] == wanted[r.conv_id]
        assert r.learned_text == "".join(t for role, t in wanted[r.conv_id] if role == "assistant")
    for r in out.collect():
        learned = [r.formatted[t.content_start : t.content_start + t.content_chars] for t in r.turns if t.learned]
        texts = [x.replace("<\\|", "<|").replace("\\\\", "\\") for x in learned]
        assert texts == [t for role, t in wanted[r.conv_id] if role == "assistant"]
        assert r.formatted.count("<|turn|>") == len(r.turns) == r.formatted.count("<|end|>")


def test_chat_equal_turns_are_ordered_by_their_text(spark, tmp_path):
    rows = [(1, 0, "user", "<a"), (1, 0, "user", "<|x"), (1, None, "user", "z"), (1, 0, "user", "\\b"), (1, 0, "user", "]c")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    con = open_tables(str(tmp_path / "none"))
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert differences(spark, con, QUERIES["op5_chat_format"], ORACLE["op5_chat_format"], str(tmp_path)) == []


def test_chat_awkward_rows(spark):
    rows = [(1, None, "user", "first"), (1, 2, None, None), (1, 2, "user", "b"), (1, 2, "user", "a"), (1, 2, "user", "a"), (None, 0, "assistant", "z")]
    found = {r.conv_id: r for r in chat.read_back(formatted(spark, rows)).collect()}
    assert [(t.role, t.text) for t in found[1].read_turns] == [("user", "first"), ("", ""), ("user", "a"), ("user", "a"), ("user", "b")]
    assert found[None].learned_text == "z" and found[1].learned_text == ""
    assert formatted(spark, rows[:0] or [(0, 0, "", "")]).limit(0).count() == 0


def test_chat_control_strings_over_several_parts(spark):
    def part(text, kind="text"):
        return (kind, text, None, None, None, None, None)

    turns = [
        ["<", "|turn|>assistant<", "", None, "|text|>x"],
        ["a\\<", "|end|>\n"],
        ["<", "<", "||", "\\", "<\\", "|"],
    ]
    rows = [(1, i, "assistant", [part(t) for t in texts]) for i, texts in enumerate(turns)]
    rows.append((1, 3, "user", [part("<"), part(None, "image"), part("|turn|>")]))
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.read_back(chat.format_conversations(df)).first()
    joined = ["".join(t or "" for t in texts) for texts in turns]
    assert r.n_turns == 4 and [t.text for t in r.read_turns] == [*joined, "<<|image|>|turn|>"]
    assert r.learned_text == "".join(joined)


def test_chat_typed_parts(spark):
    part = lambda kind, text=None, ref=None, w=None, h=None, s=None, p=None: (kind, text, ref, w, h, s, p)
    rows = [
        (1, 0, "user", [part("text", "see "), part("image", ref="i.png", w=1024, h=600), part("text", "and"), part("audio", ref="a.wav", s=2.5), part("document", ref="d.pdf", p=3)]),
        (1, 1, "assistant", [part("end", ref="odd")]),
        (1, 2, "user", None),
        (1, 3, "user", []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    r = chat.format_conversations(df).first()
    assert "<|text|>see <|image|>and<|audio|><|document|><|end|>" in r.formatted and "<|attachment|>" in r.formatted
    assert [(a.turn, a.place, a.kind, a.ref, a.tokens) for a in r.attachments] == [
        (1, 1, "image", "i.png", 85 + 170 * 4),
        (1, 3, "audio", "a.wav", 63),
        (1, 4, "document", "d.pdf", 1920),
        (2, 0, "end", "odd", 0),
    ]
    assert r.expanded_tokens == 85 + 680 + 63 + 1920 and len(r.turns) == 4


# WARC

PAGES = "page_id long, url string, html string"


def written_and_read(spark, rows, partitions=3):
    path = scratch_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(partitions), path)
    return path, warc.read_warc(spark, path).collect()


INNER = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"


def test_warc_round_trip_with_magic_inside_payloads(spark):
    payloads = [None, "", "x", "\r\n\r\nWARC/1.0\r\n", "a" + warc.SEPARATOR * 3, "\r\n\r\n" + INNER * 4, "\r\n\r\n" + INNER + "tail", "WARC/1.0\r\nContent-Length: 0\r\n\r\n", "é\U0001f600\r\n" * 700, "\r\n\r\nWARC/1.0\r\nContent-Length: 99999999\r\n\r\n"]
    rows = [(i, "http://x/\r\ny", p) for i, p in enumerate(payloads * 2)] + [(None, None, "null id")]
    _, found = written_and_read(spark, rows)
    got = sorted((r.record_id, r.record_type, bytes(r.payload).decode()) for r in found)
    # Only the payload of more than 1000 bytes is written once.
    wanted = sorted((f"<urn:page:{'' if i is None else i}>", "revisit" if i == 8 else "response", "" if i == 8 else p or "") for i, _, p in rows)
    assert got == wanted
    assert [r.refers_to for r in found if r.record_type == "revisit"] == ["<urn:page:18>"]
    assert all(r.target_uri in (None, "http://x/  y") for r in found)


@pytest.mark.parametrize("size", ["83", "100", "333", "1000"])
def test_warc_read_in_small_splits(spark, size):
    rows = [(i, "http://x", ("\r\n\r\n" + INNER) * (i % 4) + prose(i, 20 * (i % 3))) for i in range(40)]
    keys = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in keys}
    path = scratch_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame(rows, PAGES).repartition(2), path)
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        found = warc.read_warc(spark, path).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted((r.record_id, bytes(r.payload).decode()) for r in found) == sorted((f"<urn:page:{i}>", p) for i, _, p in rows)


def test_warc_broken_chain_and_empty(spark):
    path = scratch_path(spark, "test-warc")
    lost = INNER + "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
    spark.createDataFrame([(INNER + "junk" + lost,)], "value string").coalesce(1).write.option("lineSep", "\r\n\r\n").text(path)
    assert [bytes(r.payload) for r in warc.read_warc(spark, path).collect()] == [b"hello"]
    assert written_and_read(spark, [(1, "", "")][:0] or [(1, "u", "h")])[1][0].payload == b"h"
    path = scratch_path(spark, "test-warc")
    warc.write_warc(spark.createDataFrame([], PAGES), path)
    assert warc.read_warc(spark, path).count() == 0


# Exact dedup


def test_exact_dedup_awkward_rows(spark, awkward):
    found = exact_dedup.find_copies(clashing(awkward)).collect()
    by = sorted((r.doc_id or -1, r.keep_id or -1, r.group_size, r.kept) for r in found)
    assert by == sorted(
        [(-1, -1, 1, True), (1, 2, 3, False), (2, 2, 3, False), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True), (5, 5, 1, True)]
        + [(i, i, 1, True) for i in (6, 7, 8, 8, 9)]
    )
    assert {r.doc_id: r.text_sha256 for r in found}[6] == brute.sha256(prose(1, 40_000))
    kept = exact_dedup.drop_copies(clashing(awkward))
    assert kept.columns == clashing(awkward).columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 2, 4, 5, 6, 7, 8, 8, 9]
    assert exact_dedup.find_copies(awkward.limit(0)).count() == 0
    assert exact_dedup.drop_copies(awkward.limit(0)).count() == 0


def test_no_text_crosses_the_join_on_prints(spark):
    df = documents(spark, [(d, prose(d % 5, 900)) for d in range(20)])
    prints = exact_dedup._prints(df, "doc_id", "text")
    shared = prints.groupBy("print", "n_bytes").count().select("print", "n_bytes")
    plan = exact_dedup._recipes(prints, shared, exact_dedup.CHUNK)._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    moved = plan.children().apply(0).output().mkString(" ")
    assert "recipe" in moved and "body" not in moved and "parts" not in moved


def test_chunks_give_the_text_again(spark):
    texts = ["", "a", "x" * 30_000, prose(1, 20_000), "\n\U0001f600 " * 9000]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", exact_dedup.chunks(F.col("t")).alias("c"))
    rows = df.collect()
    assert all("".join(r.c) == r.t for r in rows)
    assert len(rows[3].c) > 50
    # What follows a change is cut as before.
    a, b = (exact_dedup.chunks(F.lit(t)) for t in (prose(1, 3000), "new " + prose(1, 3000)))
    x, y = spark.range(1).select(a.alias("a"), b.alias("b")).first()
    assert len(set(x) & set(y)) > len(x) / 2


def test_an_insertion_costs_a_few_chunks(spark):
    rng = random.Random(3)
    texts = {
        "prose": prose(1, 20_000),
        "codes": "".join(rng.choice("0123456789abcdef") for _ in range(60_000)),
        "mixed": "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(60_000)),
        "script": "".join(chr(rng.randint(0x4E00, 0x6FFF)) for _ in range(60_000)),
        "lines": "The same line, again and again, for what it is worth.\n" * 1500,
    }
    rows = [(k, t, t[:1000] + "some words put in" + t[1000:]) for k, t in texts.items()]
    df = spark.createDataFrame(rows, "kind string, a string, b string")
    for r in df.select("kind", *[exact_dedup.chunks(F.col(c)).alias(c) for c in "ab"]).collect():
        assert len(r.a) > 20 and len(set(r.b) - set(r.a)) <= 8, r.kind


def test_exact_dedup_tells_clashing_hashes_apart(spark, monkeypatch):
    """With a hash that is the same for all, only the verified identifiers tell contents apart."""
    texts = [(1, prose(1, 900)), (2, prose(1, 900)), (3, prose(2, 900)[: len(prose(1, 900))].ljust(len(prose(1, 900)))), (4, prose(3, 5))]
    df = documents(spark, texts)

    class Poor:
        def __getattr__(self, name):
            return (lambda *a: F.lit(7).cast("long")) if name == "xxhash64" else getattr(F, name)

    monkeypatch.setattr(exact_dedup, "F", Poor())
    found = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.find_copies(df).collect()}
    assert found == {1: (2, 2), 2: (2, 2), 3: (3, 1), 4: (4, 1)}


def test_bitmap_clears_only_what_is_not_there(spark):
    keys = spark.range(0, 3000, 3).select((F.col("id") * 977).alias("k"))
    rows = spark.range(3000).select((F.col("id") * 977).alias("k"), "id")
    clear, maybe = common.by_bitmap(rows, [F.col("k")], common.key_bitmap(keys, ["k"]))
    assert clear.filter("id % 3 = 0").count() == 0 and clear.count() + maybe.count() == 3000
    assert maybe.count() < 1010 and clear.columns == ["k", "id"]


# Mixing


def test_mixing_exponent(spark):
    shares = [0.7, 0.2, 0.07, 0.03]
    rows = [(f"s{i}", int(1000 * s), s) for i, s in enumerate(shares)]
    df = spark.createDataFrame(rows, "source string, tokens long, share double")

    def entropy(a):
        w = np.array(shares) ** a
        w /= w.sum()
        return -(w * np.log2(w)).sum()

    a = mixing.temperature(df, 1000, 0.9, 100.0)
    assert entropy(a) == pytest.approx(0.9 * 2, abs=1e-4)
    few = mixing.temperature(df, 1000, 0.999, 2.0)
    w = np.array(shares) ** few
    assert (1000 * w / w.sum() / (1000 * np.array(shares))).max() == pytest.approx(2.0, abs=1e-3)
    assert mixing.temperature(df.limit(1), 1000) == 1.0


def test_mixing_awkward_rows(spark):
    rows = [(i, prose(i, 5 + i % 7), "en", "big", 0) for i in range(400)]
    rows += [(1000 + i, prose(i, 9), "en", None, 0) for i in range(30)] + [(2000, "", "en", "none", 0), (2001, None, "en", "big", 0), (None, prose(1, 4), "en", "big", 0)]
    rows += [(5, prose(5, 10), "en", "big", 0)] * 3
    df = clashing(frame(spark, rows))
    out = mixing.mix_sources(df, budget=5000, entropy_share=0.9, max_passes=8.0, block_tokens=200)
    assert out.columns == [*df.columns, "_mixed"]
    found = out.collect()
    assert {r.source for r in found} == {"big", None}
    for source in ("big", None):
        own = [r for r in found if r.source == source]
        spent = sum(len(brute.words(r.text)) for r in own)
        assert spent == pytest.approx(5000 * own[0]._mixed.weight, abs=60)
        passes = max(r._mixed["pass"] for r in own)
        for p in range(passes):
            ids = sorted((r.doc_id or -1, r.text or "") for r in own if r._mixed["pass"] == p)
            assert ids == sorted((r[0] or -1, r[1] or "") for r in rows if r[3] == source)
        assert len({r._mixed.block for r in own if r._mixed["pass"] == 0}) > 1 or source is None
    orders = {p: [b for _, b in sorted({(r._mixed.place, r._mixed.block) for r in found if r.source is None and r._mixed["pass"] == p})] for p in (0, 1)}
    assert sorted(orders[0]) == sorted(set(orders[0]))
    assert mixing.mix_sources(df.limit(0)).count() == 0
    again = mixing.mix_sources(df.repartition(5), budget=5000, entropy_share=0.9, max_passes=8.0, block_tokens=200).collect()
    assert sorted(map(str, again)) == sorted(map(str, found))


def test_token_counts(spark):
    texts = [None, "", "  ", "a", " a\tb\n\x0bc\x0c\rd ", "a b", prose(1, 1000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(mixing.count_tokens(F.col("t")).alias("n"))
    assert [r.n for r in df.collect()] == [len(brute.words(t)) for t in texts]


# Decontamination

ITEM = "A train leaves Boston at 9 and travels 120 km in 3 hours. How fast does Alice go, says Alice to Bob, after 120 minutes of waiting there?"


def contaminated(spark, texts, items=((1, ITEM),), **options):
    docs = documents(spark, texts)
    bench = spark.createDataFrame(list(items), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.find_contaminated(docs, bench, **options).collect()}


def test_reparameterised_questions(spark):
    other = ITEM.replace("Boston", "Old Chicago").replace("120", "80").replace("9", "10").replace("Alice", "Carol").replace("Bob", "Dan Brown").replace("km", "miles")
    mixed_up = ITEM.replace("120 km", "80 km")  # 120 stands for two numbers now
    reworded = "Some train left a city early and went far. How fast was it going, asks someone, after all of that time waiting?"
    texts = [(1, ITEM), (2, prose(1, 300) + " " + ITEM + " " + prose(2, 300)), (3, other), (4, mixed_up), (5, reworded), (6, ITEM.upper().replace("?", " ??")), (7, None), (8, ""), (None, ITEM), (9, prose(4, 100))]
    found = contaminated(spark, texts)
    assert {d for d, _ in found} == {1, 2, 3, None} | ({6} if (6, 1) in found else set())
    assert found[3, 1].reparameterised and not found[1, 1].reparameterised and found[1, 1].share == 1.0


def test_copies_in_another_letter_case(spark):
    titled = " ".join(w.capitalize() for w in prose(3, 30).split())
    other = ITEM.upper().replace("120", "80").replace(" 9 ", " 10 ")
    mixed_up = ITEM.lower().replace("120 km", "80 km")
    texts = [(1, ITEM.lower()), (6, ITEM.upper().replace("?", " ??")), (2, prose(1, 300) + " " + ITEM.title() + " " + prose(2, 300)), (3, other), (4, mixed_up), (5, titled.lower()), (7, "x " + titled)]
    found = contaminated(spark, texts, [(1, ITEM), (2, titled)])
    assert set(found) == {(1, 1), (6, 1), (2, 1), (3, 1), (5, 2), (7, 2)}
    assert found[6, 1].share == 1.0 and not found[6, 1].reparameterised and found[3, 1].reparameterised


def test_decontamination_awkward_items(spark):
    text = prose(1, 40)
    items = [(1, text), (2, text), (3, "too short"), (4, None), (5, "1 2 3 4 5 6 7 8 9 10"), (None, text), (6, "")]
    found = contaminated(spark, [(1, "Before that. " + text + "\n" + text), (1, "Before that. " + text + "\n" + text), (2, "9 8 7 6 5 4 3 2 1 0"), (3, "too short")], items)
    assert set(found) == {(1, 1), (1, 2)}
    assert contaminated(spark, [(1, text)], [(1, text)][:0] or [(4, None)]) == {}
    docs = documents(spark, [(1, text), (1, text), (2, prose(2, 30)), (3, None)])
    bench = spark.createDataFrame([(1, text)], "item_id long, text string")
    kept = decontaminate.drop_contaminated(clashing(docs), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3] and kept.columns == clashing(docs).columns
    assert decontaminate.drop_contaminated(docs.limit(0), bench).count() == 0
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == 4


def test_template_tokens():
    shown = lambda t: decontaminate.Template(t, decontaminate.Lexicon()).shown(0, len(decontaminate.Template(t, decontaminate.Lexicon())))
    assert shown("We saw Mary Ann Smith buy 3.5kg, or 12 km -- for $20 (50%).") == (
        "we saw <name> buy <num> <unit> or <num> <unit> for <num> <num> <unit>",
        ["<name>mary ann smith", "<num>3.5", "<unit>kg", "<num>12", "<unit>km", "<num>20", "<num>50", "<unit>%"],
    )


@pytest.mark.parametrize("at_once", [1, 60, 1 << 19])
def test_texts_worked_on_together_are_templates_of_their_own(monkeypatch, at_once):
    """Names, numbers with units, first words and windows at the seam of two texts; a text counts its tokens from its own start."""
    seams = ["we all went to see Mary Ann", "Smith has gone to the old house.", "they ran for 12", "km is what we had to walk", "", " -- ", "a b"]
    texts = [*seams, *reversed(seams), ITEM, prose(3, 50)]
    known = SimpleNamespace(value=np.full((1 << decontaminate.MAP_BITS) // 8, 255, dtype=np.uint8))

    def hits(texts, ids):
        batch = pd.DataFrame({"doc_id": ids, "k_hash": 0, "k_len": 0, "body": texts})
        return [tuple(map(str, r)) for part in decontaminate._document_windows(5, known)([batch]) for r in part.itertuples(index=False)]

    monkeypatch.setattr(decontaminate, "AT_ONCE", at_once)
    portions = [texts[rows] for rows in decontaminate._portions(texts)]
    assert [t for p in portions for t in p] == texts and (len(portions) > 1) == (at_once < 1 << 19)
    alone = [h for i, t in enumerate(texts) for h in hits([t], [str(i)])]
    assert sorted(hits(texts, [str(i) for i in range(len(texts))])) == sorted(alone) and len(alone) > 50


def test_document_windows_forget_words(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "REMEMBERED", 1)
    assert set(contaminated(spark, [(1, ITEM), (2, prose(3, 50)), (3, ITEM)])) == {(1, 1), (3, 1)}


# Context trees


def test_ctw_equals_plain_context_trees(spark):
    texts = [(d, prose(d, 12 + d % 5) + (" É\x00 " if d % 3 else "")) for d in range(14)] + [(20, None), (21, ""), (22, "A" * 50)]
    found = {r.doc_id: r for r in ctw.score_texts(documents(spark, texts), depth=2).collect()}
    wanted = brute.lm_scores(texts)
    for d, (out, n, known, total, base, score) in wanted.items():
        r = found[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-5, abs=1e-9)


@pytest.mark.parametrize("frequent", [1 << 21, 40, 0])
def test_ctw_of_six_bytes_equals_plain_context_trees(spark, monkeypatch, frequent):
    monkeypatch.setattr(ctw, "FREQUENT_GRAMS", frequent)
    monkeypatch.setattr(ctw, "HELD_BYTES", 50)
    monkeypatch.setattr(ctw, "HELD_GRAMS", 30)
    monkeypatch.setattr(ctw, "BLOCK_TEXTS", 2)
    monkeypatch.setattr(ctw, "PIECE_GRAMS", 30)
    texts = [(d, prose(d, 12 + d % 5) + (" É\x00 " if d % 3 else "")) for d in range(14)] + [(20, None), (21, ""), (22, "A" * 50)]
    found = {r.doc_id: r.score for r in ctw.score_texts(documents(spark, texts), depth=6).collect()}
    model = brute.Ctw([brute.lowered(t).encode() for d, t in texts if not brute.held_out(d, 7, 2)], depth=6)
    assert found == pytest.approx({d: model.log10(brute.lowered(t).encode()) for d, t in texts}, rel=1e-9, abs=1e-9)


def test_ctw_query_looks_six_bytes_back(spark, tmp_path):
    rows = [(d, ("abcdefgx" if d % 2 else "zbcdefgy") * 20) for d in range(20)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: r.score for r in QUERIES["op10_ctw"](spark, str(tmp_path)).collect()}
    deep, flat = (brute.Ctw([t.encode() for d, t in rows if not brute.held_out(d, 7, 2)], depth=k) for k in (6, 2))
    assert found == pytest.approx({d: deep.log10(t.encode()) for d, t in rows}, rel=1e-9)
    assert sum(found.values()) > sum(flat.log10(t.encode()) for _, t in rows)


def test_ctw_awkward_rows(spark, awkward, monkeypatch):
    usual = {(r.doc_id, r.n_tokens): r for r in ctw.score_texts(clashing(awkward)).collect()}
    assert usual[3, 1].score == 0.0 and usual[None, 51].held_out is False
    # Few frequent words, small blocks, and words that are replaced by their hash: the same sums.
    monkeypatch.setattr(common, "PIECE", 50)
    for name, value in {"FREQUENT": 3, "HELD_WORDS": 10, "HELD_BYTES": 100}.items():
        monkeypatch.setattr(ctw, name, value)
    again = {(r.doc_id, r.n_tokens): r for r in ctw.score_texts(awkward).collect()}
    assert again.keys() == usual.keys()
    for key, r in again.items():
        assert (r.n_known, r.train_tokens) == (usual[key].n_known, usual[key].train_tokens)
        assert r.base_score == pytest.approx(usual[key].base_score) and r.score == pytest.approx(usual[key].score)
    assert ctw.score_texts(awkward.limit(0)).count() == 0
    # One task with held-out n-grams only in some of its pieces.
    monkeypatch.setattr(ctw, "PIECE_GRAMS", 4)
    mixed = documents(spark, [(d, "zq" if brute.held_out(d, 7, 2) else "a b c") for d in range(40)])
    assert mixed.coalesce(1).count() == ctw.score_texts(mixed.coalesce(1)).count()
    held = documents(spark, [(d, "a b") for d in range(200) if brute.held_out(d, 7, 2)])
    r = ctw.score_texts(held).first()
    assert (r.n_known, r.train_tokens) == (0, 0) and r.score == pytest.approx(3 * 8 * np.log10(0.5), rel=1e-6)


def test_frequent_words_are_whole_levels_within_the_bound(spark, monkeypatch):
    rows = [(f"w{i}".encode(), 2 ** (i % 9)) for i in range(90)] + [(b"x" * 40, 10**6)]
    words = spark.createDataFrame(rows, "word binary, times long")
    for most, kept in ((1000, 90), (35, 30), (9, 0)):
        monkeypatch.setattr(ctw, "FREQUENT", most)
        found = ctw._frequent(words)
        assert len(found) == kept and all(v >= np.log10(2 ** (9 - kept // 10)) for v in found.values())
    assert ctw._frequent(words.limit(0)) == {}


@pytest.mark.parametrize("depth", [1, 2, 3, 6])
def test_turned_grams_are_in_groups(depth):
    rng = np.random.default_rng(1)
    gram = np.unique(rng.integers(0, 4, size=(3000, depth + 1)) @ (256 ** np.arange(depth + 1)))
    key = ctw._turned(gram, depth)
    assert (ctw._turned_back(key, depth) == gram).all()
    group = gram & (ctw._mask(min(ctw.TOP, depth - 1) + 1) - 255)
    in_order = group[np.argsort(key)]
    assert (np.diff(in_order) != 0).sum() + 1 == len(np.unique(group))
    bucket = ctw._buckets(key, depth, 7)
    assert {g: b for g, b in zip(group.tolist(), bucket.tolist())} == {g: b for g, b in zip(group.tolist()[::-1], bucket.tolist()[::-1])}


def test_log_kt():
    for a, b in [(0, 0), (1, 0), (0, 3), (5, 9), (40, 2)]:
        assert ctw.log_kt(np.array([a]), np.array([b]))[0] == pytest.approx(brute.kt(a, b), abs=1e-9)


def test_code_lengths_of_all_bytes_add_up():
    one = np.random.default_rng(2).uniform(0.01, 0.99, size=(3, 256))
    assert np.allclose((10 ** ctw.byte_code_lengths(one)).sum(axis=1), 1)
