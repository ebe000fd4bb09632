"""The pipeline's stages on the small driver tables, each against a plain statement of its decision."""

import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from ratecraft.llm import bayes_quality  # noqa: E402
from ratecraft.llm.common import materialise  # noqa: E402

SF = os.environ.get("RATECRAFT_TEST_SF", "/root/testdata/sf0.001")


def test_stages_in_order(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    frames = [docs]
    for no, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frames.append(materialise(stage(spark, frames[-1], SF), f"t{no}"))
    rows = [{r.doc_id: r for r in f.collect()} for f in frames]
    assert all(f.columns == docs.columns and f.dtypes == docs.dtypes for f in frames[:-1])
    kept = {r.doc_id for r in bayes_quality.judge(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.kept}
    assert set(rows[1]) == kept
    lines = [line for r in rows[2].values() for line in (r.text or "").split("\n") if line.strip()]
    assert len(lines) == len(set(lines)) and set(rows[2]) <= set(rows[1])
    assert set(rows[3]) <= set(rows[2])
    assert not any(i in (r.text or "") for r in rows[4].values() for i in items)
    assert {d for d in rows[3] if not any(i in (rows[3][d].text or "") for i in items)} == set(rows[4])
    assert set(rows[5]) == set(rows[4])
    assert "n_tokens" in frames[-1].columns


def test_run_returns_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
