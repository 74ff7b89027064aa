"""The pipeline's stages, and that the rest of the library stands without this subpackage."""

import os
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyloom.llm import common as C
from tallyloom.llm import packing

from .conftest import DIR, needs_data

ROOT = Path(__file__).resolve().parent.parent.parent


@needs_data
def test_stages(spark):
    docs = C.table(spark, DIR, "documents")
    n = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        new = C.written(stage(spark, docs, DIR))
        assert new.columns == docs.columns
        n.append(new.count())
        docs = new
    assert n == sorted(n, reverse=True) and n[-1] > 0.8 * n[0] * 0.8 and n[2] == n[3]
    packed = corpus_pipeline.run(spark, DIR)
    want = packing.pack(docs, packing.default_tokenizer())
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(map(tuple, packed.select(columns).collect())) == sorted(map(tuple, want.select(columns).collect()))


def test_odd_documents_pass(spark, odd, nothing, folder):
    sf = folder(documents=odd.drop("odd.name"), benchmark=spark.createDataFrame([(1, "x")], "item_id long, text string"))
    assert corpus_pipeline.run(spark, sf).count() > 0
    empty = folder(labels=nothing)  # a folder of its own
    nothing.write.mode("overwrite").parquet(f"{empty}/e/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/e/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{empty}/e").count() == 0


@pytest.mark.parametrize("name", ["language", "near_duplicates", "decontaminate", "pack"])
def test_stages_bound_the_batches_of_their_python_steps(spark, odd, folder, name):
    """10,000 rows of 3 KB would else be one batch; a lower setting stays, and every row is handed over."""
    sf = folder(benchmark=spark.createDataFrame([(1, "x")], "item_id long, text string"))
    docs = spark.range(0, 10_000, 1, 1).select(F.format_string("%03000d", "id").alias("text"))

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows]), "bytes": pa.array([b.nbytes])})

    before = spark.conf.get(C.BATCH_SETTING)
    try:
        for setting, least, most in (("64m", 7, C.BATCH_BYTES + 4096), ("1m", 28, (1 << 20) + 4096)):
            spark.conf.set(C.BATCH_SETTING, setting)
            dict(corpus_pipeline.STAGES)[name](spark, odd, sf)
            got = docs.mapInArrow(sizes, "n long, bytes long").collect()
            assert sum(r["n"] for r in got) == 10_000 and len(got) >= least and max(r["bytes"] for r in got) <= most
    finally:
        spark.conf.set(C.BATCH_SETTING, before)


def test_the_rest_stands_alone(tmp_path):
    """A copy without the llm folders and the pipeline still imports, lists the other queries and passes their tests."""
    for part in ("tallyloom", "tests", "__spark_entry__.py"):
        subprocess.run(["cp", "-r", ROOT / part, tmp_path], check=True)
    subprocess.run(["rm", "-r", tmp_path / "tallyloom/llm", tmp_path / "tests/llm"], check=True)
    alone = {**os.environ, "PYTHONPATH": os.pathsep.join([str(tmp_path), *(p for p in sys.path if p and Path(p).resolve() != ROOT)])}
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 80 and not any(k.startswith('op') and k[2].isdigit() for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=alone)
    every = subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "--collect-only", "-p", "no:cacheprovider"], cwd=tmp_path, env=alone, capture_output=True, text=True)
    assert every.returncode == 0 and "error" not in every.stdout.splitlines()[-1], every.stdout[-2000:]
    # a few of them: all run once already, beside the subpackage
    subprocess.run([sys.executable, "-m", "pytest", "tests", "-q", "-p", "no:cacheprovider", "-k", "test_checks or upsert_latest or stub_and_empty or html_to_markdown"], cwd=tmp_path, check=True, env=alone)
