"""The pipeline: each stage on its own input, the whole against its stages, and the registry."""

import os
import re
import subprocess
import sys

import pytest
from documents import table, varied

import __spark_entry__ as registry
import corpus_pipeline
from permitry.llm import packing, queries
from test_ngram_join import expected as joined
from test_substrings import expected as passages

HERE = os.path.dirname(os.path.abspath(__file__))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    texts = [f"{t or ''} horrid awful words" if i % 7 == 0 else t for i, t in enumerate(varied(count=90))]
    table(spark, texts).write.parquet(f"{path}/documents.parquet")
    marks = [(i, 1, int(i % 7 == 0)) for i in range(len(texts))]
    spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "exact_dedup", "ngram_jaccard_join", "substring_dedup", "best_fit_packing"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, at = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()} if name != "toxicity" else None
        docs = stage(spark, docs, folder).cache()
        if name == "best_fit_packing":
            break
        assert docs.columns == columns
        at.append({r["doc_id"]: r["text"] for r in docs.collect()})
        if name == "toxicity":
            assert all(i % 7 for i in at[-1]) and len(at[-1]) > 0.8 * 6 / 7 * docs.count()
        if name == "exact_dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i] or ""), i)
            assert set(at[-1]) == set(first.values())
        if name == "ngram_jaccard_join":
            ids = sorted(before)
            kept = {ids[i] for i, _, component in joined([before[i] for i in ids]) if component == i}
            assert set(at[-1]) == kept
        if name == "substring_dedup":
            ids = sorted(before)
            for i, (_, gone, _, text) in zip(ids, passages([before[i] for i in ids], 35)):
                assert at[-1][i] == (text if gone else before[i] or "")
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    assert {r["doc_id"] for r in docs.collect()} == set(at[-1])
    whole = corpus_pipeline.run(spark, folder)
    pieces = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, whole.select(pieces).collect())) == sorted(map(tuple, docs.select(pieces).collect()))
    alone = packing.pack(spark.createDataFrame(list(at[-1].items()), "doc_id bigint, text string"), queries.tokenizer())
    assert sorted(map(tuple, alone.select(pieces).collect())) == sorted(map(tuple, whole.select(pieces).collect()))


@pytest.mark.parametrize("texts", [[], [None, "", "one two", None, "one two"]])
def test_stages_on_empty_tables_and_clashing_names(spark, folder, texts):
    """Without n_chars, with names that hold a dot or that the stages use themselves, repeated rows and missing ids."""
    docs = table(spark, texts, ids=[None, 1, 2, 3, 2][:len(texts)]).drop("n_chars")
    docs = docs.selectExpr("*", "1 AS `a.b`", "lang AS id", "lang AS row", "2 AS chunk", "true AS kept", "lang AS kept_text", "3 AS score")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, folder))
        if name != "best_fit_packing":
            assert docs.columns == columns
    kept = sorted((r["doc_id"] is not None, r["doc_id"], r["length"]) for r in docs.collect())
    assert [k[1] for k in kept] == ([1, 2] if texts else [])


def test_registered():
    names = registry.queries()
    assert [n for n in range(1, 14) if any(name.startswith(f"op{n}_") for name in names)] == list(range(1, 14))
    assert "pipeline" in names and "op3_exact_dedup" in registry.oracle_sql()


def test_registry_without_this_folder(tmp_path):
    """The other queries work where the subpackage and the pipeline are missing."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == "permitry.llm" or name.startswith("permitry.llm.") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as registry
names = registry.queries()
assert "opens_per_year" in names and not any(n.startswith("op1_") for n in names) and "pipeline" not in names
assert set(registry.oracle_sql()) <= set(names)
"""
    root = os.path.dirname(os.path.dirname(HERE))
    subprocess.run([sys.executable, "-B", "-c", code], check=True, cwd=root, timeout=120)
