"""The corpus pipeline stage by stage."""

import corpus_pipeline
from footfall.llm import quality_classifier, queries
from tests.conftest import DATA
from tests.llm.data import words_of
from tests.llm.test_pairs import joined_by_hand, removed_by_hand


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, labels = docs.columns, {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, seen[-1], DATA).write.parquet(str(tmp_path / name))
        seen.append(spark.read.parquet(str(tmp_path / name)))
        if name != "packing":
            assert seen[-1].columns == columns
    rows = [[(r.doc_id, r.text) for r in s.select("doc_id", "text").collect()] for s in seen[:-1]]
    accepted = {i for i, _ in rows[1]}
    assert sum(q == 1 and i not in accepted for i, q in labels.items()) <= 0.02 * sum(labels.values())
    assert sum(q == 0 and i in accepted for i, q in labels.items()) <= 0.05 * len(labels)
    component, _ = joined_by_hand(rows[1])
    assert sorted(i for i, _ in rows[2]) == sorted({c for c in component.values()})
    before, after = dict(rows[2]), dict(rows[3])
    by_hand = removed_by_hand([before[i].encode() for i in before])
    assert before.keys() == after.keys()
    assert all((after[i] == before[i]) == (n == 0) for i, (_, n, _, _) in zip(before, by_hand, strict=True))
    words = {i: len(words_of(t)) for i, t in after.items()}
    assert abs(sum(words[i] for i, _ in rows[4]) - sum(words.values())) <= 0.01 * sum(words.values())
    assert all(t == after[i] for i, t in rows[4])
    assert seen[-1].selectExpr("count_if(start = 0)").first()[0] == len(rows[4])


def test_registered_run(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001").toPandas()
    assert {"doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"} <= set(pieces.columns)
    assert (pieces.groupby("sequence_id").length.sum() <= 1024).all()
    assert quality_classifier.FEATURES and queries.registered()
