"""The pipeline against its stages done by hand on a small table."""

from pyspark.sql import functions as F

import corpus_pipeline
from custos.llm import secrets
from tests.conftest import SF_SMALL
from tests.llm import cases
from tests.llm.test_decontamination import brute as contained
from tests.llm.test_jaccard_join import brute as components
from tests.llm.test_packing import check as check_packing


def test_run_equals_stages_by_hand(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    kept = {i: t for i, t in docs.items() if any(c.isalpha() for c in t or "")}
    kept = {i: kept[i] for i, (_, c) in components(kept, 5, 80).items() if i == c}
    bad = {i for i, *_ in contained(list(kept.items()), items, 80)}
    texts = []
    for i, t in kept.items():
        if i not in bad:
            data, out, at = t.encode(), b"", 0
            for kind, s, e in secrets.find_spans(data):
                if s >= at:
                    out, at = out + data[at:s] + f"[{kind}]".encode(), e
                at = max(at, e)
            texts.append((i, (out + data[at:]).decode()))
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    check_packing(rows, texts, 2048)


def test_stages_keep_columns_and_take_edges(spark):
    docs = cases.docs(spark)
    for some in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, some, SF_SMALL)
            assert out.columns == docs.columns, name
            out.count()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "secret_scan", "best_fit_packing"]


def test_language_stage_without_labels_and_with_another_script(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    alien = spark.createDataFrame([(-1, "Съешь же ещё этих мягких французских булок, да выпей чаю. " * 5, None, "s", 1), (-2, "色は匂へど散りぬるを我が世誰ぞ常ならむ" * 8, None, "s", 1)], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs.union(alien), SF_SMALL).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, unlabelled, SF_SMALL).count() == docs.count()
