"""The pipeline against a plain version of each stage."""

import hashlib
import re

import corpus_pipeline
import duckdb
import pytest
from test_queries import fails_base, groups_by_brute_force, plain_fingerprint

from salescast.llm import pieces, quality, queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before the first stage and after each, written and read again as in production."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    seen, folder = [("documents", docs)], tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF_DIR).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        seen.append((name, docs))
    return seen


def rows(stages, k):
    return {r["doc_id"]: r for r in stages[k][1].collect()}


def test_order_and_columns(stages):
    assert [name for name, _ in stages] == ["documents", "quality_rules", "exact_dedup", "simhash", "mixing", "sentencepiece"]
    assert all(docs.columns == stages[0][1].columns for _, docs in stages[:5])


def test_quality_stage(spark, stages):
    before, after = rows(stages, 0), rows(stages, 1)
    passed = {i for i, r in before.items() if not fails_base(r["text"])["base_failed"]}
    kept = {r["doc_id"] for r in quality.quality_rules(stages[0][1]).where("kept").collect()}
    assert after.keys() == kept <= passed and len(kept) > 0.8 * len(passed)
    assert all(tuple(after[i]) == tuple(before[i]) for i in kept)


def test_exact_stage(stages):
    first = {}
    for i, r in sorted(rows(stages, 1).items()):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), i)
    assert rows(stages, 2).keys() == set(first.values())


def test_near_stage(stages):
    codes = {i: plain_fingerprint(r["text"]) for i, r in rows(stages, 2).items()}
    assert rows(stages, 3).keys() == set(groups_by_brute_force(codes).values())


def test_mixing_stage(stages):
    con = duckdb.connect()
    con.register("documents", stages[3][1].toPandas())
    expected = {i: n for i, n in con.execute(f"SELECT doc_id, copies FROM ({queries.OP7_SQL})").fetchall() if n}
    found = {r["doc_id"]: r["count"] for r in stages[4][1].groupBy("doc_id").count().collect()}
    assert found == expected


def test_encoding_stage(stages):
    vocabulary = pieces.Vocabulary(pieces.MODEL)
    texts = [(r["doc_id"], r["text"]) for r in stages[4][1].collect()]
    decoded = [(r["doc_id"], pieces.decode_ids(vocabulary, r["ids"])) for r in stages[5][1].collect()]
    assert sorted(decoded) == sorted(texts)


def test_encoding_stage_decodes_what_it_encoded(stages):
    texts = [(r["doc_id"], hashlib.md5((r["text"] or "").encode()).hexdigest()) for r in stages[4][1].collect()]
    assert sorted((r["doc_id"], r["text_md5"]) for r in stages[5][1].collect()) == sorted(texts)


def test_run_rereads_each_stage(spark, monkeypatch):
    seen = []
    keep = [(name, lambda s, docs, d: seen.append(docs) or docs.limit(50)) for name in ("one", "two")]
    monkeypatch.setattr(corpus_pipeline, "STAGES", keep)
    assert corpus_pipeline.run(spark, SF_DIR).count() == 50
    assert all("/table-" in docs.inputFiles()[0] for docs in seen[1:])


def test_run_equals_the_stages(spark, stages):
    found = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, found.select("doc_id", "n_pieces").collect())) == sorted(
        map(tuple, stages[5][1].select("doc_id", "n_pieces").collect())
    )
