import corpus_pipeline
from benchbook.llm import language, packing
from benchbook.llm import tokenizers_ as tok
from tests.llm.fixtures import documents
from tests.llm.test_dedup_operators import brute_similar, norm


def test_pipeline_against_brute_force(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(documents(spark).selectExpr("doc_id + 100000 as doc_id", "text", "lang", "source", "n_chars"))
    given.write.parquet(str(tmp_path / "documents.parquet"))
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    good = {r["doc_id"] for r in language.identify(given).where("lang_pred <> 'und'").collect()}
    texts = {r["doc_id"]: r["text"] for r in given.collect() if r["doc_id"] in good}
    groups = {}
    for i, t in texts.items():
        groups.setdefault(norm(t), []).append((-len(t), i))
    kept = {min(g)[1] for g in groups.values()}
    roots = brute_similar({i: texts[i] for i in kept})
    want = {i for i in kept if roots[i] == i}
    assert {r["doc_id"] for r in pieces} == want
    by_doc = {}
    for r in pieces:
        by_doc[r["doc_id"]] = by_doc.get(r["doc_id"], 0) + r["length"]
    ids = packing.encode([texts[i] for i in sorted(want)], tok.BYTE_BPE_JSON, tok.BYTE_BPE_RANKS)
    assert by_doc == {i: len(x) + 1 for i, x in zip(sorted(want), ids, strict=True)}


def test_stages_keep_the_columns(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, "").columns == docs.columns
