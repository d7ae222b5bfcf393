import brute
from test_minhash_packing import check_packing

import corpus_pipeline
from millrace.llm import toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages_equal_brute_force_each_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    toxic = {r.doc_id for r in toxicity.query(spark, SMALL).where("predicted = 1").collect()}
    out = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SMALL)
        rows = out.collect()
        if name == "packing":
            assert check_packing(rows, before) < 0.02
            break
        assert out.columns == columns and all(r.n_chars == len(r.text) for r in rows)
        after = {r.doc_id: r.text for r in rows}
        if name == "toxicity":
            assert set(after) == {i for i, _ in before} - toxic and toxic
        if name == "line_dedup":
            want = {i: sha for i, _, _, sha in brute.op7(before)}
            assert {i: brute.sha(t) for i, t in after.items()} == want
        if name == "near_dedup":
            assert set(after) == {i for i, _, _, kept in brute.op3(before, 80) if kept}
        if name == "decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            assert set(after) == {x[0] for x in brute.op5(before, items) if not x[-1]}
        docs = spark.createDataFrame(rows, out.schema)
    assert {(r.doc_id, r.start, r.ids_crc32) for r in corpus_pipeline.run(spark, SMALL).collect()} == {(r.doc_id, r.start, r.ids_crc32) for r in rows}


def test_stages_take_nulls_empty_texts_extra_columns_and_no_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, n_hit long"
    docs = spark.createDataFrame([(1, None, None, None, None, "a", 1), (2, "", "en", "s", 0, "b", 2), (None, "a b", None, "s", 3, "c", 3), (4, "a " * 9, "en", "s", 18, "d", 4)], schema)
    for frame, n in ((docs, 4), (docs.limit(0), 0)):
        own = frame
        for _, stage in corpus_pipeline.STAGES[:-1]:
            own = stage(spark, own, SMALL)
            assert own.columns == docs.columns and own.count() == n
        assert corpus_pipeline.STAGES[-1][1](spark, own, SMALL).select("doc_id").distinct().count() == n


def test_each_stage_begins_with_executors_that_gave_back_memory(spark):
    beans = list(spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans())
    full = lambda: sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        if name in ("decontamination", "packing"):  # these ask for no collection of their own
            before = full()
            stage(spark, docs, SMALL)
            assert full() > before
