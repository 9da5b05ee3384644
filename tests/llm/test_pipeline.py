"""corpus_pipeline over documents with planted cases."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import brute
from tests.llm.test_operators import prose


def planted(path):
    rng = random.Random(21)
    clean = [prose(rng, 60) for _ in range(60)]
    bench = [prose(rng, 30) for _ in range(5)]
    bad = [f"{prose(rng, 30)} idiot moron {prose(rng, 10)} scum" for _ in range(40)]
    near = [" ".join(t.split()[:-1] + ["changed"]) for t in clean[:6]]
    leaks = [f"{prose(rng, 20)} {bench[i]} {prose(rng, 20)}" for i in range(5)]
    texts = clean + bad + near + clean[6:9] + leaks + [None, ""]
    docs = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "lang": ["en"] * len(texts), "source": ["s"] * len(texts), "n_chars": pa.array([len(t or "") for t in texts], pa.int64())})
    pq.write_table(docs, f"{path}/documents.parquet")
    labels = list(range(30)) + list(range(60, 90))
    pq.write_table(pa.table({"doc_id": pa.array(labels, pa.int64()), "quality": pa.array([1] * 60, pa.int32()), "toxic": pa.array([0] * 30 + [1] * 30, pa.int32())}), f"{path}/labels.parquet")
    pq.write_table(pa.table({"item_id": pa.array(range(5), pa.int64()), "text": bench}), f"{path}/benchmark.parquet")
    return texts


def test_pipeline_catches_planted_cases_and_keeps_the_rest(spark, tmp_path):
    texts = planted(tmp_path)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/out-{name}")
        docs = spark.read.parquet(f"{tmp_path}/out-{name}")
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
    clean = set(range(60))
    assert kept["toxicity"] == clean | set(range(100, len(texts)))
    assert kept["line_dedup"] == kept["toxicity"]
    classes = brute.near_classes([(d, texts[d]) for d in sorted(kept["line_dedup"])])
    assert kept["near_dedup"] == set(classes.values()) and clean <= kept["near_dedup"]
    assert kept["decontamination"] == kept["near_dedup"] - set(range(109, 114))
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept["decontamination"]
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 1024").count() == 0


def test_copies_of_several_lines_leave_no_scraps(spark, tmp_path):
    rng = random.Random(22)
    firsts = [[prose(rng, 12) for _ in range(5)] for _ in range(24)]
    changed = [prose(rng, 12) for _ in firsts]
    texts = ["\n".join(x) for x in firsts * 2] + ["\n".join(x[:2] + [y] + x[3:]) for x, y in zip(firsts, changed)]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    lines = stages["line_dedup"](spark, docs, str(tmp_path))
    lines.write.parquet(f"{tmp_path}/lines")
    left = {r.doc_id: r.text for r in stages["near_dedup"](spark, spark.read.parquet(f"{tmp_path}/lines"), str(tmp_path)).collect()}
    assert left == dict(enumerate(texts[:24])) | {24: ""} | {48 + i: y for i, y in enumerate(changed)}
