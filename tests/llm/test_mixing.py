from collections import defaultdict

import pytest

from tests.llm import brute, fixtures
from wardline.llm import mixing, queries


def check(rows, sizes, tolerance):
    """`rows` of a mix; `sizes`: {doc_id: (size, source)}."""
    by_source = defaultdict(int)
    for size, source in sizes.values():
        by_source[source] += size
    want, taken = brute.mix_targets(by_source), defaultdict(int)
    for r in rows:
        size, source = sizes[r.doc_id]
        assert (r.size, r.source_size) == (size, by_source[source])
        assert r.target == pytest.approx(want[source], rel=1e-9, abs=1e-9)
        assert 0 <= r.taken <= 3 * size
        taken[source] += r.taken
    for source, goal in want.items():
        assert abs(taken[source] - goal) <= max(2.5 * mixing.BLOCK, tolerance * goal), source


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = queries.op9_mixing(spark, sf_dir)
    assert got.count() == len(docs)
    check(got.collect(), {r.doc_id: (len(brute.words(r.text)), r.source) for r in docs}, 0.02)


def test_odd_rows_many_shards_and_reruns(spark):
    rows = fixtures.odd_rows() + [(100 + i, "w " * (i % 90), None, f"s{i % 4}") for i in range(400)]
    docs = fixtures.documents(spark, rows)
    sizes = {r[0]: (len(brute.words(r[1])), r[3]) for r in rows}
    got = mixing.mix(docs, shard=64).collect()
    assert len(got) == len(rows)
    check(got, sizes, 0.1)
    again = mixing.mix(docs.repartition(7), shard=64).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_empty_and_without_words(spark):
    assert mixing.mix(fixtures.empty(spark)).count() == 0
    blank = fixtures.documents(spark, [(1, None, None, None), (2, " ", None, "a"), (None, "", None, "a")])
    assert sorted(r.taken for r in mixing.mix(blank).collect()) == [0, 0, 0]


def test_repeated_rows(spark):
    rows = [(1, "a b c " * 40, None, "s")] * 3 + [(2, "d " * 500, None, "t")]
    got = mixing.mix(fixtures.documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in got) == [1, 1, 1, 2]
    assert all(r.taken <= 3 * r.size for r in got)


def test_caps_follow_the_loop(spark):
    cases = [{"a": 10, "b": 1000, "c": 5, None: 70}, {"x": 1}, {"a": 0, "b": 30, "c": 2}, {c: 7 * i for i, c in enumerate("abcdefgh")}]
    for sizes in cases:
        df = spark.createDataFrame([(s, n, 1) for s, n in sizes.items()], "source string, source_size long, n long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(brute.mix_targets(sizes))


def test_no_python_on_the_executors(spark, sf_dir):
    plan = queries.op9_mixing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_shards_hold_the_blocks_of_words_that_the_mix_takes(spark):
    rows = [(i, " ".join(f"{i}.{k}" for k in range(i % 83)), None, f"s{i % 3}" if i % 4 else None) for i in range(300)]
    docs = fixtures.documents(spark, rows)
    blocks = mixing.mixed_blocks(docs, shard=64).collect()
    places = sorted((r.shard, r.slot) for r in blocks)
    assert len(set(places)) == len(places) and max(p[0] for p in places) > 3 and all(0 <= p[1] < 64 for p in places)
    source, taken = {r[0]: r[3] for r in rows}, defaultdict(int)
    for r in blocks:
        assert 0 < len(r.words) <= mixing.BLOCK
        last = None
        for doc, k in (map(int, w.split(".")) for w in r.words):
            assert source[doc] == r.source and (last is None or last[0] != doc or k == last[1] + 1)
            last = doc, k
            taken[doc] += 1
    assert sum(len(r.words) < mixing.BLOCK for r in blocks) <= 4 * mixing.REPEATS
    assert all(r.taken == taken[r.doc_id] for r in mixing.mix(docs, shard=64).collect())


def test_sources_alternate_within_a_shard(spark):
    rows = [(i, "w " * 100, None, f"s{i % 5}") for i in range(300)]
    blocks = mixing.mixed_blocks(fixtures.documents(spark, rows), shard=256).orderBy("shard", "slot").collect()
    shards = defaultdict(list)
    for r in blocks:
        shards[r.shard].append((r.slot, r.source))
    for placed in shards.values():
        assert [slot for slot, _ in placed] == list(range(len(placed)))
        changes = sum(a[1] != b[1] for a, b in zip(placed, placed[1:]))
        even = sum(1 - sum(s == t for _, t in placed) / len(placed) for _, s in placed)
        assert len(placed) < 20 or changes > 0.7 * even
