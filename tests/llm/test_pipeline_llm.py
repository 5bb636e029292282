"""The pipeline: every stage on its predecessor's rows, odd rows included."""

import importlib

from pyspark.sql import functions as F

from conftest import SF
from test_near_dup_llm import plain_fingerprint


def test_stages(spark, tmp_path):
    pipeline = importlib.import_module("corpus_pipeline")
    assert [n for n, _ in pipeline.STAGES] == ["quality_classifier", "line_dedup", "simhash_near_dedup", "mixing", "byte_level_bpe"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    good = docs.filter("length(text) > 500").select("text").first()["text"]
    odd = spark.createDataFrame([(90_001, None, "en", "s", 0), (90_002, "", None, None, None), (None, good, "en", "s", 5), (90_003, good, "en", "s", 5),
                                 (90_003, good, "en", "s", 5), (90_004, (good + "\n") * 60, "en", "s", 5)], docs.schema)
    clash = {"rate": F.lit("a"), "copies": F.lit(1), "score": F.lit(2), "key": F.lit(3), "removed_lines": F.lit("b"), "fp": F.lit(4), "component_id": F.lit(5), "n_tokens": F.lit(6)}
    docs = docs.unionByName(odd).withColumns(clash)
    rows = {}
    for k, (name, step) in enumerate(pipeline.STAGES):
        out = step(spark, docs, SF)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        rows[name] = out.count()
        assert rows[name] > 0
        if k < 4:
            assert out.columns == docs.columns
        before, docs = docs, out
        if name == "simhash_near_dedup":
            fps = [plain_fingerprint(r["text"]) for r in before.collect()]
            kept = [plain_fingerprint(r["text"]) for r in out.collect()]
            assert set(kept) <= set(fps) and len(set(kept)) == len(kept)
            for i, a in enumerate(kept):
                assert all((a ^ b).bit_count() > 2 for b in kept[i + 1:])
    assert rows["line_dedup"] <= rows["quality_classifier"] and rows["byte_level_bpe"] == rows["mixing"]
    for name, step in pipeline.STAGES:
        empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
        assert step(spark, empty, SF).count() == 0


def test_run(spark):
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert names["pipeline"](spark, SF).count() > 0
