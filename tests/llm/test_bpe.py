"""Byte-pair encoding against the library whose files it reads."""

from __future__ import annotations

import hashlib
import json
import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from hydroflow.llm import bpe
from hydroflow.llm.queries import QUERIES

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(PATH)


TEXTS = [
    "",
    " \t\n",
    "Hello, World! don't I'LL we've 'S x'd",
    "<|startoftext|>a<|endoftext|><|endoftext|> b <|ENDOFTEXT|> <|endof",
    "ΣΑΣ ΟΔΟΣ İstanbul Å é Ǆ ﬁ",
    "12 3½ ⅷ ٣ 漢字かな 한글 \U0001f600‍\U0001f600",
    "a\x1cb\x85c\xa0d　e​f﻿g\x00h",
    "word</w> </w> ÿĀ",
    "a" * 3000 + "ab" * 500 + "!" * 777 + "=-" * 300,
]


def test_ids_equal_the_library(library, vocabulary):
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzäé"
    names = [n.replace("</w>", "") for n in vocabulary.ids]
    assigned = [c for c in map(chr, range(0x20, 0x3000)) if unicodedata.category(c) != "Cn"]
    texts = [
        *TEXTS,
        *["".join(rng.choice(letters[: rng.choice([2, 3, 28])]) for _ in range(rng.randint(1, 40))) for _ in range(4000)],
        *["".join(rng.choice(names) for _ in range(rng.randint(2, 4))) for _ in range(8000)],
        *["".join(rng.choice(assigned) for _ in range(12)) for _ in range(2000)],
    ]
    mine = [ids.tolist() for ids in vocabulary.encode(texts)]
    assert mine == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [vocabulary.decode(ids) for ids in mine] == [library.decode(ids, skip_special_tokens=False) for ids in mine]


def test_neighbours_fit_exactly_where_merging_keeps_them(vocabulary):
    inner, final, _ = vocabulary._tables
    rng = random.Random(2)
    a, b = rng.choices(list(inner.items()), k=6000), rng.choices(list(final.items()), k=6000)
    fits = vocabulary.compatible(*(bpe.np.array([n for _, n in side]) for side in (a, b)))
    kept = [vocabulary.merged(x + y) == [m, n] for (x, m), (y, n) in zip(a, b, strict=True)]
    assert fits.tolist() == kept
    assert 0 < sum(kept) < len(kept)


def test_only_words_that_fail_are_merged(vocabulary, monkeypatch):
    merged = []
    own = bpe.Vocabulary.merged
    monkeypatch.setattr(bpe.Vocabulary, "merged", lambda self, word: merged.append(word) or own(self, word))
    words = {"hello", "unbelievable", "straßenbahn", "internationalization", "zqxjkv"}
    learned = vocabulary._learn(words)
    assert len(merged) < len(words)
    assert all(list(learned[w]) == own(vocabulary, w.encode()) for w in words)


def test_pieces_and_forgotten_words_change_nothing(library, monkeypatch):
    text = " ".join(f"word{i} Ünï{i * 7} don't<|endoftext|>" for i in range(400))
    monkeypatch.setattr(bpe, "PIECE", 50)
    monkeypatch.setattr(bpe, "REMEMBERED", 20)
    monkeypatch.setattr(bpe, "HELD", 30)
    small = bpe.read_vocabulary(PATH)
    again = small.encode([text, "", text])
    wanted = library.encode(text, add_special_tokens=False).ids
    assert [x.tolist() for x in again] == [wanted, [], wanted]


def test_merges_out_of_order_are_merged_exactly():
    spec = json.loads(open(PATH, encoding="utf-8").read())
    spec["model"]["merges"] = list(reversed(spec["model"]["merges"]))
    source = json.dumps(spec)
    own, other = bpe.Vocabulary(source), tokenizers.Tokenizer.from_str(source)
    assert not own.ordered
    texts = ["reversed merges give other tokens", "aaaaaaa banana bandana"]
    assert [x.tolist() for x in own.encode(texts)] == [e.ids for e in other.encode_batch(texts, add_special_tokens=False)]


def test_other_kinds_of_files_are_refused():
    with pytest.raises(ValueError, match="not supported"):
        bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))


def test_rows(spark, vocabulary):
    df = spark.createDataFrame([(1, None, "x"), (1, "hi hi", "y"), (None, "", "z"), (1, "hi hi", "y")], "doc_id long, text string, ids string")
    out = bpe.encode(df, vocabulary)
    assert out.columns == ["doc_id", "text", "ids", "_ids"]
    back = bpe.decode(out, vocabulary, ids="_ids", into="text")
    rows = [(r.text, r._ids, r._text) for r in back.collect()]
    hi = vocabulary.ids["hi</w>"]
    assert sorted(rows, key=repr) == sorted([(None, [], ""), ("hi hi", [hi, hi], "hi</w> hi</w>"), ("", [], ""), ("hi hi", [hi, hi], "hi</w> hi</w>")], key=repr)
    assert bpe.encode(df.limit(0), vocabulary).count() == 0
    odd = spark.createDataFrame([(None,), ([hi, None, -1, 10**6],)], "ids array<int>")
    assert sorted(r.decoded for r in bpe.decode(odd, vocabulary).collect()) == ["", "hi</w>"]


def test_query_equals_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    found = {r.doc_id: r for r in QUERIES["op11_bpe"](spark, sf_dir).collect()}
    assert len(found) == len(docs)
    for doc in docs:
        ids = library.encode(doc.text, add_special_tokens=False).ids
        r = found[doc.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
