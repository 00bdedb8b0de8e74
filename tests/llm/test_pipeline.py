import pyarrow as pa

import corpus_pipeline
from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"


def test_pipeline_filters_and_encodes(spark):
    out = corpus_pipeline.run(spark, SF).toPandas()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas().set_index("doc_id")
    ids = set(out.doc_id)
    assert list(out.columns) == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert ids < {r.doc_id for r in docs.select("doc_id").collect()} and len(ids) == len(out)
    clean = labels[(labels.quality == 1) & (labels.toxic == 0)].index
    junk = labels[labels.quality == 0].index
    assert len(ids & set(clean)) > 0.7 * len(clean) and len(ids & set(junk)) < 0.3 * len(junk)


def test_few_texts_at_a_time_go_to_the_encoder(spark, monkeypatch):
    def sizes(docs, *vocabulary):
        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

        return docs.mapInArrow(run, "n long")

    monkeypatch.setattr(corpus_pipeline.byte_bpe, "digests", sizes)
    docs = spark.range(1000).selectExpr("id doc_id", "'a' text").coalesce(1)
    seen = [r.n for r in corpus_pipeline.encode_texts(spark, docs, SF).collect()]
    assert sum(seen) == 1000 and max(seen) <= 256


def test_all_ten_and_the_pipeline_are_registered():
    names = queries()
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))


def test_functions_for_tasks_stay_small():
    """What travels with every task, after the driver has used the word tables itself."""
    import numpy as np
    from pyspark import cloudpickle

    from panelforge.llm import byte_bpe, jaccard_join, resample, toxicity, words

    toxicity.identity_swaps()
    weights = resample.Weights(np.zeros((resample.FOLDS, 1 << resample.BITS), np.float32))
    for f in (words.split_words, jaccard_join._measure, resample._count, weights.of, byte_bpe.Encoder.encode):
        assert len(cloudpickle.dumps(f)) < 3_000_000
