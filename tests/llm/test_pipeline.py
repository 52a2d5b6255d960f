"""The pipeline, stage by stage, against brute-force versions; and what happens without the package."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import brute
import corpus_pipeline
import pytest

from hydroflow.llm import quality

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = [docs.collect()]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == COLUMNS
        rows = docs.collect()
        kept.append(rows)
        docs = spark.createDataFrame([r[:5] for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return dict(zip(["documents", *[n for n, _ in corpus_pipeline.STAGES]], kept, strict=True))


def ids(rows):
    return sorted(r.doc_id for r in rows)


def test_quality_stage(spark, sf_dir, stages):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.score_quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels).collect()
    assert ids(stages["quality"]) == sorted(r.doc_id for r in scored if r.predicted == 1)
    marks = {r.doc_id: r.quality for r in labels.collect()}
    kept = set(ids(stages["quality"]))
    good = [d for d, q in marks.items() if q == 1]
    assert sum(d in kept for d in good) > 0.98 * len(good)


def test_exact_stage(stages):
    last = {}
    for r in stages["quality"]:
        last[r.text] = max(r.doc_id, last.get(r.text, -1))
    assert ids(stages["exact_dedup"]) == sorted(last.values())


def test_simhash_stage(stages):
    found = brute.simhash([(r.doc_id, r.text) for r in stages["exact_dedup"]])
    assert ids(stages["simhash"]) == sorted({c for _, c in found.values()})


def test_decontamination_stage(spark, sf_dir, stages):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = [r.doc_id for r in stages["simhash"] if not any(brute.contained(r.text, i) for i in items)]
    assert len(clean) < len(stages["simhash"]) and ids(stages["decontamination"]) == sorted(clean)


def test_mixing_stage(stages):
    given = {r.doc_id for r in stages["decontamination"]}
    assert {r.doc_id for r in stages["mixing"]} <= given
    total = sum(len(brute.words(r.text)) for r in stages["decontamination"])
    for source in {r.source for r in stages["mixing"]}:
        own = [r for r in stages["mixing"] if r.source == source]
        assert sum(len(brute.words(r.text)) for r in own) == pytest.approx(total * own[0].mixed.weight, abs=10_000)


@pytest.mark.parametrize("awkward", [[], [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "", "en", None, 0), (2, "", "en", "s", 0)]])
def test_pipeline_of_no_texts(spark, sf_dir, tmp_path, awkward):
    """No documents, or none with a word, go through all stages: none of them is worth keeping or has a share in the mix."""
    for name in ("labels", "benchmark"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{sf_dir}/{name}.parquet")
    docs = spark.createDataFrame(awkward, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_entry_without_the_package(tmp_path):
    root = Path(__file__).resolve().parents[2]
    for path in root.rglob("*.py"):
        name = path.relative_to(root)
        if "llm" not in name.parts and name.name != "corpus_pipeline.py":
            (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / name).write_bytes(path.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(k.startswith('op') or k == 'pipeline' for k in q); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
