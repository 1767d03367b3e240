import numpy as np
import pytest
from pyspark.sql import functions as F

from readloom.llm import one_bit
from readloom.llm.queries import QUERIES


def vectors(spark, rows, **extra):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    for name, value in extra.items():
        df = df.withColumn(name, F.lit(value))
    return df


def usable(rows):
    out = []
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            out.append((i, np.array(v, np.float32).astype(np.float64)))
    return out


def brute(rows, k, every=20):
    rows, out = usable(rows), {}
    for q, v in rows:
        if q % every == 0:
            near = [(-float((v * w).sum()), i) for i, w in rows if i != q and len(w) == len(v)]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_codes_estimate_within_the_bound():
    rng = np.random.default_rng(0)
    vectors, queries = rng.standard_normal((500, 64)), rng.standard_normal((50, 64))
    centre, turn = vectors.mean(axis=0), one_bit.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    bits, length, fit = one_bit.encode(vectors, centre, turn)
    assert bits.shape == (500, 8)
    guess, spread = one_bit.estimates(bits, length, fit, queries @ turn, 3.0)
    error = np.abs(guess - queries @ (vectors - centre).T) / np.sqrt((queries**2).sum(axis=1))[:, None]
    assert (error <= spread).mean() > 0.99


@pytest.mark.parametrize("blocks", [(8192, 1024), (64, 7)])
def test_against_brute_force(spark, blocks):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(32).astype(np.float32).tolist()) for i in range(600)]
    df = vectors(spark, rows, rank=1, score="x")
    near = one_bit.nearest(df, F.col("vec_id") % 20 == 0, k=20, candidate_block=blocks[0], query_block=blocks[1])
    ours, expected = found(near), brute(rows, 20)
    assert ours.keys() == expected.keys()
    hits = sum(len({i for i, _ in ours[q]} & {i for i, _ in expected[q]}) for q in ours)
    assert hits >= 0.99 * 20 * len(ours)
    scores = {(q, i): s for q in expected for i, s in expected[q]}
    for q in ours:
        for i, s in ours[q]:
            assert s == pytest.approx(scores.get((q, i), s), abs=1e-12)


def test_ties_repeats_and_odd_vectors(spark):
    rng = np.random.default_rng(2)
    same = rng.standard_normal(8).astype(np.float32).tolist()
    rows = [(i, same) for i in range(100)] + [(200 + i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(50)]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [None] + [1.0] * 7), (304, [float("nan")] * 8)]
    rows += [(305, [float("inf")] * 8), (320, [1.0, 2.0]), (321, [2.0, 1.0]), (None, same), (0, same)]
    near = found(one_bit.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5))
    assert [i for i, _ in near[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _ in near[20]] == [0, 0, 1, 2, 3]
    assert near[320] == [(321, 4.0)]
    assert 300 not in near and all(i not in range(300, 306) for v in near.values() for i, _ in v)


def test_an_id_in_many_rows_is_dealt_out(spark):
    rng = np.random.default_rng(4)
    rows = [(1, rng.standard_normal(4).astype(np.float32).tolist()) for _ in range(300)] + [(20 * i, [1.0, 0.0, 0.0, float(i)]) for i in range(5)]
    near = found(one_bit.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0, k=5, candidate_block=32))
    expected = brute(rows, 5)
    assert {q: [round(s, 9) for _, s in v] for q, v in near.items()} == {q: [round(s, 9) for _, s in v] for q, v in expected.items()}


def test_few_candidates_and_empty_table(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5])]
    assert found(one_bit.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0)) == {0: [(1, 0.5)]}
    assert one_bit.nearest(vectors(spark, rows).where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    ours, expected = found(QUERIES["op4_one_bit"].run(spark, sf)), brute(rows, 20)
    assert ours.keys() == expected.keys()
    hits = sum(len({i for i, _ in ours[q]} & {i for i, _ in expected[q]}) for q in ours)
    assert hits >= 0.99 * sum(map(len, expected.values()))
