"""Every stage of the pipeline against brute force, on what the stage before it kept."""

import public_tokenizers
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import corpus_pipeline
from modelweave.llm import quality
from tests.llm import test_chosen_path, test_line_dedup, test_spaced_seeds
from tests.llm.cases import documents, edge_documents, no_documents


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_stages_and_run(spark, small, tmp_path):
    before = documents(spark, small)
    columns = before.columns
    labels = spark.read.parquet(f"{small}/labels.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, before, small).write.parquet(f"{tmp_path}/{name}")
        after = spark.read.parquet(f"{tmp_path}/{name}")
        given = pairs(before)
        if name == names[0]:
            good = {r.doc_id for r in quality.classify(before, labels).collect() if r.predicted == 1}
            assert sorted(pairs(after)) == sorted((i, t) for i, t in given if i in good)
        elif name == names[1]:
            want = sorted((i, t) for i, t, _, _ in test_line_dedup.brute(given))
            assert sorted(pairs(after)) == want
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif name == names[2]:
            kept = {i for i, _, part in test_chosen_path.brute(given, corpus_pipeline.NEAR) if i == part}
            assert sorted(pairs(after)) == sorted((i, t) for i, t in given if i in kept)
        elif name == names[3]:
            held = {d for d, _ in test_spaced_seeds.brute(given, items)}
            assert sorted(pairs(after)) == sorted((i, t) for i, t in given if i not in held)
        else:
            ids = {i: library.encode(t, add_bos=True, add_eos=True) for i, t in given}
            assert {r.doc_id: r.ids for r in after.collect()} == ids
            assert all(r.n_tokens == len(r.ids) for r in after.collect())
        if name != names[-1]:
            assert after.columns == columns
        before = after
    run = {tuple((r.doc_id, r.n_tokens, *r.ids)) for r in corpus_pipeline.run(spark, small).collect()}
    assert run == {tuple((r.doc_id, r.n_tokens, *r.ids)) for r in before.collect()}


def test_stages_over_awkward_rows(spark, small):
    """Nulls, empty and long texts, repeated rows and clashing names; no stage loses or doubles a row it should not."""
    assert corpus_pipeline.NEAR == 80
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    for docs in (edge_documents(spark), no_documents(spark)):
        docs = docs.withColumn("n_lines", F.lit(1)).withColumn("hits", F.lit(1)).withColumn("key", F.lit("k"))
        given = pairs(docs)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            found = stage(spark, docs, small)
            assert found.columns == docs.columns
            got = sorted(pairs(found), key=repr)
            if name == "quality_classifier":
                assert set(got) <= set(given)
            elif name == "line_deduplication":
                assert [t or "" for _, t in got] == [
                    t for _, t in sorted(((i, t) for i, t, _, _ in test_line_dedup.brute(given)), key=repr)]
            elif name == "near_deduplication":
                kept = {i for i, _, part in test_chosen_path.brute(given, 80) if part is None or i == part}
                assert got == sorted(((i, t) for i, t in given if i in kept), key=repr)
            else:
                held = {d for d, _ in test_spaced_seeds.brute([g for g in given if g[0] is not None], items)}
                assert got == sorted(((i, t) for i, t in given if i not in held), key=repr)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, small)
        assert last.count() == len(given)
