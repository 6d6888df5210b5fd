"""The pipeline on the smallest tables, stage by stage."""

import corpus_pipeline
from scrutin.llm import decontamination, neardup, pii, quality
from scrutin.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_agree_with_their_operators(spark):
    docs = table(spark, SF, "documents")
    for (name, stage), last in zip(corpus_pipeline.STAGES, [False] * 4 + [True]):
        out = stage(spark, docs, SF).cache()
        ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
        if name == "quality":
            assert ids(out) == ids(quality.quality_scores(docs, table(spark, SF, "labels")).where("predicted = 1"))
        if name == "near_duplicates":
            assert ids(out) == ids(neardup.near_duplicates(docs).where("keep"))
        if name == "decontamination":
            assert ids(out) == ids(decontamination.contamination(docs, table(spark, SF, "benchmark")).where("not contaminated"))
        if name == "personal_data":
            assert ids(out) == ids(docs) and pii.personal_data(out).where("n_email + n_phone + n_ip + n_card > 0").count() == 0
        assert out.columns == docs.columns or last and set(docs.columns) < set(out.columns)
        docs = out
    assert corpus_pipeline.run(spark, SF).count() == docs.count()
