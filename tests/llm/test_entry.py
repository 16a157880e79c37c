"""Registered queries, their SQL, the pipeline and the entry's guard."""

import os
import re
import subprocess
import sys

import numpy as np
import pytest
from helpers import dedup_lines, docs, empty, jaccard_components, removed_bytes

import corpus_pipeline
from tablewise.llm import queries, tokens

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    sys.path.insert(0, os.path.join(REPO, "tests"))
    from oracle_check import compare, duck
    res = compare(queries.QUERIES[name](spark, SMALL), duck(SMALL), queries.ORACLE_SQL[name])
    assert res["cols_match"] and res["values_match"] and not res["types"], res


def test_digests_against_brute_force(spark):
    import hashlib
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = jaccard_components(rows, 3, 90, 100)
    got = queries.QUERIES["op4_ngram_join"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    gone = {i: (len(t), sum(g), hashlib.sha256(bytes(b for b, x in zip(t, g) if not x)).hexdigest())
            for (i, _), (t, g) in zip(rows, removed_bytes([t for _, t in rows], 200))}
    got = queries.QUERIES["op2_suffix_dedup"](spark, SMALL).collect()
    assert {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in got} == gone
    vectors = spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()
    x = np.array([r["embedding"] for r in vectors], np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    degree = (x @ x.T >= 0.95).sum(axis=1) - 1
    got = queries.QUERIES["op3_embedding_dedup"](spark, SMALL).collect()
    assert {r["vec_id"]: r["n_links"] for r in got} == {r["vec_id"]: int(n) for r, n in zip(vectors, degree)}


def test_pipeline_stages_against_brute_force(spark, tmp_path):
    d = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality rules", "line dedup", "n-gram Jaccard join", "suffix-array dedup",
                            "best-fit packing"]

    def run(name, df):
        stages[name](spark, df, SMALL).write.parquet(str(tmp_path / name.replace(" ", "_")))
        out = spark.read.parquet(str(tmp_path / name.replace(" ", "_")))
        return out, {r["doc_id"]: r["text"] for r in out.collect()} if "text" in out.columns else None
    passed, rows = run("quality rules", d)
    assert passed.columns == d.columns and 0 < len(rows) < d.count()
    before = {r["doc_id"]: r["text"] for r in d.collect()}
    assert all(before[i] == t for i, t in rows.items())
    lined, after = run("line dedup", passed)
    gone = dedup_lines(sorted(rows.items()))
    assert after == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i]) for i, t in rows.items()}
    unique, kept = run("n-gram Jaccard join", lined)
    groups = jaccard_components(after.items(), 5, 8, 10)
    assert set(kept) == {c for _, c in groups.values()}
    cut, left = run("suffix-array dedup", unique)
    ids = sorted(kept)
    assert left == {i: bytes(b for b, x in zip(t, g) if not x).decode("utf-8", "ignore")
                    for i, (t, g) in zip(ids, removed_bytes([kept[i] for i in ids], 200))}
    assert cut.columns == d.columns and cut.where("n_chars != length(text)").count() == 0
    packed, _ = run("best-fit packing", cut)
    enc = tokens.encoder(tokens.default_vocabulary())
    lengths = {i: len(b) // 4 + 1 for i, b in zip(ids, enc.encode([left[i].encode() for i in ids]))}
    got = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg({"length": "sum"})
           .withColumnRenamed("sum(length)", "n").collect()}
    assert got == lengths


def test_stages_on_odd_tables(spark, tmp_path):
    from helpers import odd_rows
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for k, d in enumerate((docs(spark, odd_rows()), empty(spark))):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, d, str(tmp_path)).count() <= max(k == 0, 1) * 10_000


def test_copies_of_a_row_without_an_id_go(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(None, a), (5, a), (7, a + " end"), (8, a), (None, b), (9, b + " end"), (11, b)]
    out = corpus_pipeline.near_duplicates(spark, docs(spark, rows), SMALL)
    got = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(None, a), (5, a), (None, b), (9, b + " end")], key=str)


def test_texts_that_share_an_id_go_one_by_one(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (5, a + " end"), (5, b), (5, b), (6, c), (6, c + " end"), (6, None)]
    out = corpus_pipeline.near_duplicates(spark, docs(spark, rows), SMALL)
    got = sorted(((r["doc_id"], (r["text"] or "-").removesuffix(" end")) for r in out.collect()))
    assert got == [(1, a), (5, b), (6, "-"), (6, c)]


def test_entry_works_without_the_package(tmp_path):
    """The other queries stay when the package and the pipeline are missing;
    an error inside them is not hidden."""
    code = """
import sys
class Gone:
    def find_spec(self, name, path=None, target=None):
        if name == {missing!r}:
            raise ModuleNotFoundError(name, name=name)
sys.meta_path.insert(0, Gone())
import __spark_entry__ as e
print(len(e.queries()), "pipeline" in e.queries(), len(e.oracle_sql()))
"""
    def run(missing):
        return subprocess.run([sys.executable, "-c", code.format(missing=missing)], cwd=REPO, text=True,
                              capture_output=True, env=os.environ | {"PYTHONPATH": REPO})
    for missing in ("corpus_pipeline", "tablewise.llm"):
        assert "False" in run(missing).stdout
    assert run("tablewise.llm.packing").returncode != 0


def test_settled_tables_keep_rows_in_few_files(spark):
    from tablewise.llm.common import settle
    df = spark.range(50_000).repartition(40).withColumnRenamed("id", "x")
    got = settle(df, rows_per_file=20_000)
    assert got.rdd.getNumPartitions() == 3
    assert got.agg({"x": "sum"}).first()[0] == sum(range(50_000))
    assert settle(df.limit(0)).count() == 0
    assert not df.storageLevel.useMemory and "Scan" in got._jdf.queryExecution().toString()
