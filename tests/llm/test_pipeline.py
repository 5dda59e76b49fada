from __future__ import annotations

from collections import Counter

import corpus_pipeline
from clienttrail.llm.queries import oracle_sql, queries

from test_simhash import plain_components, plain_fingerprint
from test_substring import plain_removal


def test_stages_one_after_the_other(spark, small_dir, small_documents):
    documents, kept = small_documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, documents, small_dir)
        assert result.columns == small_documents.columns and result.dtypes == small_documents.dtypes
        rows = [(r["doc_id"], r["text"]) for r in result.collect()]
        kept[name] = rows
        documents = spark.createDataFrame(result.collect(), small_documents.schema)
    clean = kept["language"]
    assert len(clean) > 0.98 * small_documents.count()

    prints = [(d, plain_fingerprint(t)) for d, t in clean]
    least = set(plain_components(prints))
    assert sorted(d for d, _ in kept["near_duplicates"]) == sorted(least)

    unique = kept["near_duplicates"]
    wanted = {d: words for (d, _), (_, words) in zip(unique, plain_removal(unique))}
    got = {d: (t or "").split() for d, t in kept["repeated_passages"]}
    assert got == {d: w for d, w in wanted.items() if w or not dict(unique)[d].split()}

    before, after = Counter(kept["repeated_passages"]), Counter(kept["mixing"])
    assert set(after) <= set(before) and sum(after.values()) > 0.7 * sum(before.values())


def test_run(spark, small_dir, small_documents):
    packed = corpus_pipeline.run(spark, small_dir).toPandas()
    assert packed["doc_id"].isin([r["doc_id"] for r in small_documents.select("doc_id").collect()]).all()
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
    assert (packed.groupby("doc_id")["length"].sum() == packed.groupby("doc_id")["doc_tokens"].first()).all()


def test_run_without_documents(spark, small_dir, small_documents, tmp_path):
    small_documents.limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{small_dir}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_names():
    names = list(queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(oracle_sql()) <= set(names)
    assert corpus_pipeline.ORACLE_SQL is None
