import hashlib

from tests.llm import brute, fixtures
from wardline.llm import pii, queries

CASES = [
    "mail a.b+c@ex-ample.co.uk, x@y and p@q.r_s@t.u then a@b.c@d.e é😀 z@z.zz",
    "ip 1.2.3.4.5.6.7.8 and 300.1.1.1 then 0000255.0.0.01 9.9.9.9é1.1.1.1",
    "card 4845168114407329 4845-1681-1440-7329 4845 1681 1440 7328 1 2 3",
    "call +1 (555) 010-9999 or +49.30.1234567890123456 or +1- tel 555-7713 x",
    "IBAN: GB82 WEST 1234 5698 7654 32 and GB83WEST12345698765432 DE89370400440532013000",
    "+" * 50 + "1 2 3 4 5 6 7 8" + "+9" * 30,
    "1.1.1.1 " * 700,
]


def check(rows, want):
    for r in rows:
        spans = want[r.doc_id]
        by_kind = [sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone")]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == by_kind
        assert r.base_sha256 == hashlib.sha256(brute.listed(spans).encode()).hexdigest()
        assert r.spans.startswith(brute.listed(spans))


def test_cases_and_odd_rows(spark):
    rows = [(50 + i, t, None, None) for i, t in enumerate(CASES)] + fixtures.odd_rows()
    got = pii.personal_data(fixtures.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    check(got, {r[0]: brute.pii_base(r[1]) for r in rows})


def test_checks_and_context_add_spans(spark):
    rows = [(1, CASES[4], None, None), (2, CASES[3], None, None), (3, "555-7713 alone", None, None)]
    got = {r.doc_id: r for r in pii.personal_data(fixtures.documents(spark, rows)).collect()}
    assert [got[i].n_iban for i in (1, 2, 3)] == [2, 0, 0]
    assert [got[i].n_local_phone for i in (1, 2, 3)] == [0, 1, 0]
    assert "iban:6:33" in got[1].spans.split(",")


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = queries.op1_pii(spark, sf_dir).collect()
    assert len(got) == len(docs)
    check(got, {r.doc_id: brute.pii_base(r.text) for r in docs})


def test_empty(spark):
    assert pii.personal_data(fixtures.empty(spark)).count() == 0


def test_no_python_on_the_executors(spark, sf_dir):
    plan = queries.op1_pii(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
