"""The pipeline's stages against what each should do to its own input."""

from __future__ import annotations

import corpus_pipeline
from conftest import SF_SMALL

from strata.llm import edit_decontam
from strata.llm.common import table


def test_stages(spark):
    docs = table(spark, SF_SMALL, "documents").cache()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "secrets", "encoding"]
    stage = dict(corpus_pipeline.STAGES)
    calm = stage["toxicity"](spark, docs, SF_SMALL)
    assert calm.columns == docs.columns
    labels = table(spark, SF_SMALL, "labels")
    clean = labels.where("toxic = 0").join(docs, "doc_id")
    assert calm.join(labels.where("toxic = 0"), "doc_id").count() >= 0.95 * clean.count()
    toxic = labels.where("toxic = 1")
    assert calm.join(toxic, "doc_id").count() < docs.join(toxic, "doc_id").count()
    single = stage["near_duplicates"](spark, docs, SF_SMALL)
    assert single.columns == docs.columns and single.count() < docs.count()
    assert single.select("text").distinct().count() == single.count()
    free = stage["decontamination"](spark, docs, SF_SMALL)
    bench = table(spark, SF_SMALL, "benchmark")
    bad = {r.doc_id for r in edit_decontam.matches(docs, bench).collect()}
    assert {r.doc_id for r in free.collect()} == {r.doc_id for r in docs.collect()} - bad
    masked = stage["secrets"](spark, docs, SF_SMALL)
    assert masked.count() == docs.count() and masked.where("text rlike '(?i)passw(or)?d *[=:] *[a-z0-9]{6}'").count() == 0
    assert stage["encoding"](spark, docs, SF_SMALL).count() == docs.count()
    empty = docs.limit(0)
    assert all(f(spark, empty, SF_SMALL).count() == 0 for _, f in corpus_pipeline.STAGES[1:])


def test_run(spark):
    assert 0 < corpus_pipeline.run(spark, SF_SMALL).count() < table(spark, SF_SMALL, "documents").count()
