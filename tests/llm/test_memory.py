"""Bounds of what an executor and its Python workers hold in the pipeline."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from opinari.llm import tokens, wordids
from opinari.llm.queries import vocabulary_path

KEY = corpus_pipeline.BATCH_BYTES[0]


@pytest.fixture
def own_bound(spark):
    before = spark.conf.get(KEY, None)
    spark.conf.unset(KEY)
    yield spark
    spark.conf.unset(KEY)
    if before is not None:
        spark.conf.set(KEY, before)


def test_batches_of_the_pipeline_are_bounded_by_bytes(own_bound):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], names=["rows", "bytes"])

    docs = own_bound.createDataFrame([(1, "one text", "en")], "doc_id long, text string, lang string")
    texts = own_bound.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("ab "), 1000).alias("text"))
    corpus_pipeline.language_id(own_bound, docs, "")
    got = texts.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r[0] for r in got) == 4000 and max(r[1] for r in got) < 2 << 20


def test_a_bound_of_the_session_is_kept(own_bound):
    own_bound.conf.set(KEY, "512k")
    corpus_pipeline._small_batches(own_bound)
    assert own_bound.conf.get(KEY) == "512k"


def test_a_worker_forgets_merged_pre_tokens():
    class Shared:
        value = tokens.load(vocabulary_path())

    texts = [f"zq{k}xv{k * 7919} wqz{k}," for k in range(300)]
    few = wordids.of_worker(Shared, 50, 20)
    ids, bounds = few.of(pa.array(texts))
    held = few.vocabulary._loaded["m"]
    assert len(held) + len(held.old) <= 20 and len(few.keys) >= len(set(" ".join(texts).split()))
    plain = Shared.value.tokenizer
    assert [ids[i:j].tolist() for i, j in zip(bounds, bounds[1:])] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    ids, bounds = few.of(pa.array(["zq1xv7919"]))
    assert len(few.keys) == 1 and ids.tolist() == plain.encode("zq1xv7919", add_special_tokens=False).ids
