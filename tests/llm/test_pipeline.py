import corpus_pipeline
from quizlake.llm.queries import ORACLE, QUERIES
from quizlake.llm.store import saved, table
from quizlake.llm import decontam, langid, sketch_join, toxicity
from tests.llm.helpers import SF001, awkward


def test_registered():
    import __spark_entry__ as entry

    known = entry.queries()
    assert set(QUERIES) <= set(known) and known["pipeline"] is corpus_pipeline.run
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLE) <= set(QUERIES)


def test_every_stage_works_on_what_the_one_before_kept(spark):
    docs = table(spark, SF001, "documents")
    columns = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = saved(stage(spark, docs, SF001), f"test-{name}")
        ids = [r[0] for r in docs.select("doc_id").collect()]
        kept = [r[0] for r in out.select("doc_id").collect()]
        assert set(kept) <= set(ids) and len(kept) == len(set(kept))
        if i < 4:
            assert out.columns == columns
        if name == "toxicity":
            bad = toxicity.score_toxicity(docs, table(spark, SF001, "labels")).where("predicted = 1")
            assert set(ids) - set(kept) == {r[0] for r in bad.select("doc_id").collect()}
        if name == "language":
            bad = langid.predict(docs).where("rejected")
            assert set(ids) - set(kept) == {r[0] for r in bad.select("doc_id").collect()}
        if name == "near_copies":
            assert set(kept) == {r[0] for r in sketch_join.near_copies(docs).select("component_id").collect()}
        if name == "benchmark_text":
            assert decontam.match(out, table(spark, SF001, "benchmark")).where("contaminated").count() == 0
        docs = out
    assert docs.where("taken <= 0 or taken > 3 * size").count() == 0


def test_stages_on_awkward_and_empty_tables(spark):
    for rows in (awkward(spark), awkward(spark).where("false")):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            docs = saved(stage(spark, docs, SF001), f"awkward-{name}")
        assert docs.count() <= rows.count()
