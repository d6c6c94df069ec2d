import brute
import corpus_pipeline

from tidemark.llm.common import read, written


def test_stages(spark, folder):
    docs = read(spark, folder, "documents")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, folder), "test-stage")
        rows = docs.collect()
        assert rows, name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns, name
        if "mixing" not in name and "token" not in name:
            ids = [r.doc_id for r in rows]
            assert len(ids) == len(set(ids)) <= before, name
            before = len(ids)
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert brute.ordered(corpus_pipeline.run(spark, folder).collect()) == brute.ordered(rows)


def test_awkward_rows(spark, folder):
    """Names that clash, nulls and repeated rows go through every stage; an empty table stays empty."""
    for rows in (brute.awkward(), []):
        docs = brute.documents(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            found = written(stage(spark, docs, folder), "test-stage")
            assert name == corpus_pipeline.STAGES[-1][0] or found.columns == docs.columns
            assert bool(rows) or found.count() == 0
            docs = found
