import random

import pytest

import corpus_pipeline
from pullscope.llm.decontaminate import leaks
from pullscope.llm.minhash import near_dedup
from pullscope.llm.mixing import mix
from pullscope.llm.text import table
from pullscope.llm.toxicity import toxicity

SMALL = "/root/testdata/sf0.001"


def test_stages_are_those_asked_for():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "decontamination", "mixing", "tokens"]


def test_each_stage_does_its_operators_work(spark, tmp_path):
    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        ids = sorted(r[0] for r in out.select("doc_id").collect())
        if name == "toxicity":
            want = [r["doc_id"] for r in toxicity(docs, table(spark, SMALL, "labels")).where("predicted = 0").collect()]
        elif name == "near_dedup":
            want = [r["doc_id"] for r in near_dedup(docs).where("kept").collect()]
        elif name == "decontamination":
            bad = {r["doc_id"] for r in leaks(docs, table(spark, SMALL, "benchmark")).collect()}
            want = [r["doc_id"] for r in docs.collect() if r["doc_id"] not in bad]
        elif name == "mixing":
            want = [r["doc_id"] for r in mix(docs).collect() for _ in range(r["repeats"])]
        else:
            want = [r["doc_id"] for r in docs.collect()]
        assert ids == sorted(want), name
        assert k == 4 or out.columns == columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    whole = corpus_pipeline.run(spark, SMALL)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("wide", [False, True])
def test_odd_rows_pass_every_stage(spark, frame, odd_rows, tmp_path, wide):
    rng = random.Random(1)
    rows = [r for r in odd_rows if r[0] not in (6, 7)] + [(50 + i, " ".join(rng.choices("abcdefgh", k=20))) for i in range(20)]
    for n, own in enumerate((rows, [])):
        docs = frame(own, wide)
        columns = docs.columns
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, SMALL)
            assert k == 4 or out.columns == columns
            out.write.parquet(f"{tmp_path}/{n}-{k}")
            docs = spark.read.schema(out.schema).parquet(f"{tmp_path}/{n}-{k}")
        assert docs.count() >= len(own) // 2 and set(docs.columns) >= {"doc_id", "start", "n_tokens", "ids_crc32"}
