"""What queries leave in the shared folder."""

from __future__ import annotations

import uuid

import corpus_pipeline
import pytest
from tests.conftest import SMALL

from finloom import storage
from finloom.llm.queries import queries


@pytest.mark.parametrize("name, most", [("op1_jaccard_join", 4), ("op3_substring_dedup", 3), ("op5_line_dedup", 0), ("op8_quality_rules", 1), ("op9_source_mix", 4), ("op11_merkle_manifest", 12), ("op12_decontamination", 2), ("op13_importance_resampling", 2), ("pipeline", 1)])
def test_tables_left(spark, tmp_path, monkeypatch, name, most):
    """Only what the lazy result reads is left, and nothing after a release."""
    storage.release(spark)
    monkeypatch.setattr(storage, "shared_dir", lambda spark, label: f"file://{tmp_path}/{label}-{uuid.uuid4().hex}")
    run = corpus_pipeline.run if name == "pipeline" else queries()[name]
    run(spark, SMALL).write.format("noop").mode("overwrite").save()
    assert len(list(tmp_path.iterdir())) <= most, sorted(p.name for p in tmp_path.iterdir())
    storage.release(spark)
    assert list(tmp_path.iterdir()) == []
