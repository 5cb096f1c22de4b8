import corpus_pipeline
from chronoctx.llm import queries
from chronoctx.plans.session import store
from llm_cases import hostile


def test_stages_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns
        kept.append(docs.count())
    assert kept[0] > kept[1] == kept[2] > kept[3] == kept[4]
    texts = {r.doc_id for r in docs.collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r.doc_id for r in rows} == texts
    assert "sequence_id" in rows[0].asDict()


def test_hostile_documents_pass_every_stage(spark, sf_dir):
    docs = hostile(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = store(stage(spark, docs, sf_dir), "stage")
        assert name == "packing" or out.columns == docs.columns
        none = store(stage(spark, docs.limit(0), sf_dir), "stage")
        assert none.count() == 0
        docs = out


def test_every_operator_has_a_query():
    names = [q.__name__ for q in queries.QUERIES]
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)]
