"""The stages of the pipeline, each against a plain version of its decision."""

import corpus_pipeline
from forecourt.llm import decontaminate, queries
from tests.llm.test_dedup import plain_components, plain_fingerprint, plain_lines
from tests.llm.test_filters import edit_distance, plain_quality
from tests.llm.test_tokens import check_packing


def test_stages_in_turn(spark, folder, documents):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "SimHash near-dedup", "benchmark decontamination", "best-fit packing"]

    kept = stages["quality rules"](spark, documents, folder).cache()
    verdict = {r["doc_id"]: r["kept"] for r in queries.quality_rules(spark, folder).collect()}
    assert {r["doc_id"] for r in kept.collect()} == {i for i, k in verdict.items() if k}
    failed = {x[0] for x in plain_quality([(r["doc_id"], r["text"]) for r in documents.collect()]) if x[-1]}
    assert failed and not failed & {r["doc_id"] for r in kept.collect()}

    lines = stages["line dedup"](spark, kept, folder).cache()
    assert lines.dtypes == documents.dtypes
    want = {x[0]: x for x in plain_lines([(r["doc_id"], r["text"]) for r in kept.collect()])}
    for r in lines.collect():
        assert r["n_chars"] == len(r["text"])
        assert (r["text"].count("\n") + 1 if r["text"] else 0) in (want[r["doc_id"]][1] - want[r["doc_id"]][2], 0)

    single = stages["SimHash near-dedup"](spark, lines, folder).cache()
    groups = plain_components([(r["doc_id"], plain_fingerprint(r["text"])) for r in lines.collect()])
    assert single.dtypes == documents.dtypes
    assert sorted(r["doc_id"] for r in single.collect()) == sorted({c for _, _, c in groups})

    clean = stages["benchmark decontamination"](spark, single, folder).cache()
    items = [decontaminate.item_words(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    gone = {r["doc_id"]: r["text"] for r in single.collect()}
    for r in clean.collect():
        gone.pop(r["doc_id"])
    for text in gone.values():
        words = decontaminate.item_words(text)
        assert any(edit_distance(x, words) <= decontaminate.edits_allowed(len(x), 0.8) for x in items)

    packed = stages["best-fit packing"](spark, clean, folder)
    check_packing(packed.collect(), {r["doc_id"]: r["text"] for r in clean.collect()})


def test_run_equals_its_stages(spark, folder, documents):
    docs = documents
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, folder)
    check_packing(corpus_pipeline.run(spark, folder).collect(), {r["doc_id"]: r["text"] for r in docs.collect()})


def test_stages_on_edge_rows_and_on_nothing(spark, folder, edge, nothing):
    for docs in (edge, nothing):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            out.collect()
            if name != "best-fit packing":
                assert out.columns == docs.columns
