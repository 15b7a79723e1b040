"""The corpus pipeline against plain-Python versions of its stages."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from civicspark.llm import quality
from civicspark.llm.queries import queries
from tests.llm.frames import low
from tests.llm.test_exact_and_contamination import _contamination
from tests.llm.test_near_and_repeats import _components
from tests.llm.test_row_operators import _library

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents_table(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_stages_follow_the_contract(spark, documents_table):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "exact_dedup", "near_dedup", "benchmark_decontamination", "bpe_encoding",
    ]
    nothing = documents_table.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, nothing, SF)
        assert out.columns == documents_table.columns and out.count() == 0


#: Every column name that the stages use inside, with values of types that theirs do not have.
INSIDE = (
    "kept p_low p_toxic site_low site_toxic post_low post_toxic _site0 _site1 _low_hash _n_copies _k_id _k_hash _bad_id _bad_hash _o_id _o_hash "
    "_text_hash _group _copy n n_rows n_shingles component_id keep_id group_size n_copies level name text_sha256 hit hits items word pos words start len "
    "c0 c1 c2 c3 low toxic style lexical _label_id comp node band host path contaminated bands f1 f2"
).split()


def test_columns_with_any_name_pass_unchanged(spark):
    base = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    shadowed = base.select("*", *(F.concat(F.lit(f"{name}:"), F.col("doc_id")).alias(name) for name in INSIDE), F.struct(F.lit(1).alias("a.b")).alias("dotted.name"))
    docs, want = shadowed, shadowed.toPandas().set_index("doc_id", drop=False)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.dtypes == shadowed.dtypes, name
    left = docs.toPandas()
    assert 0 < len(left) < len(want)
    for r in left.to_dict("records"):
        assert r == want.loc[r["doc_id"]].to_dict()
    plain = base
    for _, stage in corpus_pipeline.STAGES[:-1]:
        plain = stage(spark, plain, "/root/testdata/sf0.001")
    assert sorted(left["doc_id"]) == sorted(r["doc_id"] for r in plain.collect())


def test_run_matches_plain_python(spark, documents_table):
    heads = quality.fit(documents_table, spark.read.parquet(f"{SF}/labels.parquet"))
    scored = quality.score(documents_table, heads)
    kept = quality.judge(scored, quality.site_posteriors(scored)).where("kept").collect()
    texts = {r["doc_id"]: r["text"] for r in kept}
    assert 0.7 * documents_table.count() < len(texts) < documents_table.count()

    last = defaultdict(int)
    for i, t in texts.items():
        last[low(t)] = max(last[low(t)], i)
    texts = {i: t for i, t in texts.items() if last[low(t)] == i}
    near = _components(list(texts.items()))
    texts = {i: t for i, t in texts.items() if near[i][1] == i}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    contaminated = {k[0] for k in _contamination(list(texts.items()), items) if k[-1]}
    texts = {i: t for i, t in texts.items() if i not in contaminated}
    assert contaminated

    got = queries()["pipeline"](spark, SF).collect()
    assert {r["doc_id"]: r["text"] for r in got} == texts and len(got) == len(texts)
    source = {r["doc_id"]: r for r in documents_table.collect()}
    for r in got:
        assert (r["lang"], r["source"], r["n_chars"]) == (source[r["doc_id"]]["lang"], source[r["doc_id"]]["source"], source[r["doc_id"]]["n_chars"])
    for r in got[::20]:
        assert (r["ids"], r["decoded"]) == _library(r["text"])
