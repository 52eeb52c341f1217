"""The corpus pipeline stage by stage against brute force, and on odd tables."""

import hashlib

import corpus_pipeline
from pyspark.sql import functions as F
from test_corpus_operators import WORD, brute_classes, brute_hits, brute_repeats, odd_docs, rows

from tidemark.llm.common import stage, table


def test_each_stage_does_its_work_on_what_the_one_before_kept(spark, sf_dir):
    docs, seen = table(spark, sf_dir, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        before = docs
        docs = stage(step(spark, docs, sf_dir), name)
        seen.append((name, rows(before), rows(docs)))
        assert name == "source_mixing" or docs.columns == list(corpus_pipeline.COLUMNS)
    ids = [({r["doc_id"] for r in a}, {r["doc_id"] for r in b}) for _, a, b in seen]
    assert [n for n, _, _ in seen] == ["language_id", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "source_mixing"]
    assert ids[0][1] == {r["doc_id"] for r in seen[0][1] if r["text"] and any(c.isalpha() for c in r["text"])}
    assert ids[1][1] == {i for i, c, _ in brute_classes(seen[1][1]) if i == c}
    want = {i: sha for i, _, _, sha in brute_repeats(seen[2][1])}
    assert {r["doc_id"]: hashlib.sha256(" ".join(WORD.findall(r["text"])).encode()).hexdigest() for r in seen[2][2]} == want
    assert ids[3][1] == {x[0] for x in brute_hits(seen[3][1], rows(table(spark, sf_dir, "benchmark"))) if not x[5]}
    mixed = {r["doc_id"]: r for r in seen[4][2]}
    assert mixed.keys() == ids[4][0] and all(mixed[r["doc_id"]]["size"] == len(WORD.findall(r["text"])) for r in seen[4][1])
    assert abs(sum(r["taken"] for r in mixed.values()) - sum({(r["source_size"], r["target"]): r["target"] for r in mixed.values()}.values())) <= 8


def test_pipeline_of_odd_and_empty_tables(spark, sf_dir):
    odd = odd_docs(spark)
    for docs in (odd, odd.where("false"), odd.withColumn("lang", F.lit(None).cast("string"))):
        n = docs.count()
        for _, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, sf_dir), "odd")
            assert docs.count() <= n
