from collections import Counter

import corpus_pipeline
from tablehaul.llm.queries import QUERIES
from tests.llm.helpers import frame
from tests.llm.test_similar import kept_by_hand

FOLDER = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_clean_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r.text for r in left.collect()}
        after = stage(spark, left, FOLDER)
        assert after.columns == docs.columns, name
        rows = after.collect()
        ids = {r.doc_id for r in rows}
        assert ids <= set(before)
        if name == "quality rules":
            judged = {r.doc_id: r.kept for r in QUERIES["op1_quality_rules"](spark, FOLDER).collect()}
            assert ids == {i for i, kept in judged.items() if kept}
            assert not [i for i in set(before) - ids if labels.get(i) == 1 and len(before[i].split()) > 200 and len(set(before[i].split())) > 150]
        if name == "near duplicates":
            assert ids == kept_by_hand(list(before.items()))
        if name == "secret scan":
            assert ids == set(before) and all(r.n_chars == len(r.text) for r in rows)
        left = spark.createDataFrame(rows, docs.schema)
    copies = Counter(r.doc_id for r in left.collect())
    packed, total, sequences = corpus_pipeline.STAGES[-1][1](spark, left, FOLDER).collect(), Counter(), {}
    tokens = {r.doc_id: r.doc_tokens for r in packed}
    for r in packed:
        total[r.doc_id] += r.length
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert total == {i: n * tokens[i] for i, n in copies.items()}
    for parts in sequences.values():
        ends = [0, *(a + n for a, n in sorted(parts))]
        assert [a for a, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048


def test_no_documents(spark):
    left = frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, FOLDER)
        assert left.count() == 0
