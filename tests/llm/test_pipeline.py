"""The pipeline's stages against plain versions of what they decide."""

import pytest

import corpus_pipeline
from catalogflow.session import materialize
from tests.llm.test_bag_minhash import brute as brute_classes
from tests.llm.test_wu_manber import brute as brute_hits

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def ids(frame):
    return sorted(r.doc_id for r in frame.select("doc_id").collect())


def test_columns_stay(steps):
    assert all(s.dtypes == steps[0].dtypes for s in steps[:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "benchmark_decontamination", "encoding",
    ]


def test_near_duplicates_leave_one(steps):
    rows = [(r.doc_id, r.text) for r in steps[2].collect()]
    assert ids(steps[3]) == sorted(d for d, least in brute_classes(rows) if d == least)


def test_few_near_copies_among_what_the_rules_kept_stay(steps):
    """Judged on the texts as they entered line dedup, not on what it left of them.

    A copy with a change in most of its lines shares few of them as they are; it is cut all the same.
    """
    texts = {r.doc_id: r.text for r in steps[1].collect()}
    left = set(ids(steps[3]))
    least = dict(brute_classes(list(texts.items())))
    copies = [d for d in left if least[d] != d and least[d] in left]
    assert len(copies) <= 0.2 * sum(least[d] != d for d in texts)


def test_contaminated_documents_go(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r.doc_id, r.text) for r in steps[3].collect()]
    assert ids(steps[4]) == sorted(d for d, *_, hit in brute_hits(rows, items) if not hit)


def test_run_gives_the_last_stage(spark, steps, rows):
    assert rows(corpus_pipeline.run(spark, SF)) == rows(steps[-1])
