import pytest

from tests.llm import brute, fixtures
from wardline.llm import exact_dedup, queries


def result(df):
    return {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()}


@pytest.mark.parametrize("digest_bytes", [32, 1, 0])
def test_odd_rows_and_colliding_digests(spark, digest_bytes):
    rows = fixtures.odd_rows() + [(100 + i, f"Text {i % 7}", None, None) for i in range(50)]
    docs = fixtures.documents(spark, rows).repartition(5)
    got = result(exact_dedup.exact_groups(docs, digest_bytes=digest_bytes, salts=3))
    assert got == brute.exact([(r[0], r[1]) for r in rows])


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = brute.exact([(r.doc_id, r.text) for r in docs.collect()])
    assert result(queries.op6_exact_dedup(spark, sf_dir)) == want


def test_empty(spark):
    assert exact_dedup.exact_groups(fixtures.empty(spark)).count() == 0


def test_rows_that_stay_keep_their_columns(spark):
    rows = [(1, "a b", "en", "s"), (2, "A B", "en", "s"), (2, "A B", "en", "s"), (3, None, None, None)]
    docs = fixtures.documents(spark, rows)
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 3]
