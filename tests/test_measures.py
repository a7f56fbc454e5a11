"""Similarity formulas against the worked fixtures (FIXTURES.md A and B)."""

import pytest

from conftest import SPARSE, TOY, ratings_df
from corate.operators.item_similarity import item_similarity
from corate.operators.pair_similarity import pair_similarity
from corate.operators.user_knn import agreement_knn, l1_knn


def r6(x):
    return None if x is None else round(x, 6)


def sims(df, col="sim"):
    return {(r["item_a"], r["item_b"]): r6(r[col]) for r in df.collect()}


def test_toy_item_measures(spark):
    r = ratings_df(spark, TOY)
    cos = sims(item_similarity(r, "cosine"))
    assert cos[(1, 2)] == 0.998273 and cos[(1, 4)] == 0.989071 and cos[(3, 4)] == 0.999175
    adj = sims(item_similarity(r, "adjusted_cosine"))
    assert adj == {(1, 2): 1.0, (1, 3): -1.0, (1, 4): -1.0, (2, 3): -1.0, (2, 4): -1.0, (3, 4): 1.0}
    pea = sims(item_similarity(r, "pearson"))
    assert set(pea.values()) == {1.0} and len(pea) == 6


def test_toy_pair_similarity(spark):
    p = pair_similarity(ratings_df(spark, TOY))
    rows = {(x["item_a"], x["item_b"]): x for x in p.collect()}
    assert len(rows) == 6
    assert r6(rows[(1, 2)]["pearson"]) == 1.0
    assert r6(rows[(1, 2)]["cosine"]) == 0.998273
    assert r6(rows[(1, 2)]["cosine_unrooted"]) == 0.003278
    assert r6(rows[(2, 4)]["cosine_unrooted"]) == 0.00248
    assert all(x["jaccard"] is None for x in rows.values())


def test_sparse_item_measures(spark):
    r = ratings_df(spark, SPARSE)
    cos = sims(item_similarity(r, "cosine"))
    assert cos == {(10, 20): 0.982905, (10, 30): 0.157877, (10, 40): 0.276172,
                   (20, 30): 0.160623, (20, 40): 0.374634, (30, 40): 0.685994}
    adj = sims(item_similarity(r, "adjusted_cosine"))
    # deviations are 1e-6 fixed point: agree to about 1e-6
    assert adj == pytest.approx({(10, 20): 0.616578, (10, 30): -0.876712, (10, 40): 0.0,
                                 (20, 30): -0.717473, (20, 40): -0.406371,
                                 (30, 40): -0.248282}, abs=2e-6)
    pea = sims(item_similarity(r, "pearson"))
    assert pea == {(10, 20): 0.5, (10, 30): -0.288675, (20, 30): -0.57735}


def test_sparse_pair_similarity(spark):
    p = {(x["item_a"], x["item_b"]): x for x in pair_similarity(ratings_df(spark, SPARSE)).collect()}
    assert r6(p[(10, 20)]["pearson"]) == 0.5 and p[(10, 30)]["pearson"] is None
    assert r6(p[(10, 20)]["cosine"]) == 0.982905 and r6(p[(10, 30)]["cosine"]) == 1.0
    assert r6(p[(10, 20)]["cosine_unrooted"]) == 0.016949
    assert r6(p[(10, 40)]["cosine_unrooted"]) == 0.166667
    jac = {k: r6(v["jaccard"]) for k, v in p.items()}
    assert jac == {(10, 20): 3.0, (10, 30): 0.5, (10, 40): 0.5, (20, 30): 1.0,
                   (20, 40): 0.333333, (30, 40): 0.5}


L1 = {(1, 2): 2, (1, 3): 6, (1, 4): 15, (1, 5): 14, (2, 3): 4, (2, 4): 15, (2, 5): 12,
      (3, 4): 11, (3, 5): 12, (4, 5): 9}
AGREE = {(1, 2): 3.0, (1, 3): 1.75, (1, 4): 0.5, (1, 5): 0.0, (2, 3): 2.666667, (2, 4): 0.0,
         (2, 5): 0.0, (3, 4): 1.25, (3, 5): 0.0, (4, 5): 0.0}
TOY_L1 = {(1, 2): 16, (1, 3): 32, (1, 4): 48, (2, 3): 16, (2, 4): 32, (3, 4): 16}
TOY_AGREE = {(1, 2): 1.0, (1, 3): -3.0, (1, 4): -7.0, (2, 3): 1.0, (2, 4): -3.0, (3, 4): 1.0}


@pytest.mark.parametrize("data,expected", [(SPARSE, L1), (TOY, TOY_L1)])
def test_user_l1_all_pairs(spark, data, expected):
    r = ratings_df(spark, data)
    users = r.select("user_id").distinct()
    got = {}
    for x in l1_knn(r, users, k=10).collect():
        got[(min(x["query_user"], x["user_id"]), max(x["query_user"], x["user_id"]))] = x["distance"]
    assert got == {k: float(v) for k, v in expected.items()}


@pytest.mark.parametrize("data,expected", [(SPARSE, AGREE), (TOY, TOY_AGREE)])
def test_user_agreement_all_pairs(spark, data, expected):
    r = ratings_df(spark, data)
    users = r.select("user_id").distinct()
    got = {}
    for x in agreement_knn(r, users, k=10, fill=True).collect():
        got[(min(x["query_user"], x["user_id"]), max(x["query_user"], x["user_id"]))] = r6(x["similarity"])
    assert got == expected


def test_nearest_by_l1_can_share_no_item(spark):
    # user 4's nearest is user 5, with whom it shares nothing
    r = ratings_df(spark, SPARSE)
    q = r.select("user_id").where("user_id = 4").distinct()
    top = l1_knn(r, q, k=1).collect()
    assert [(x["user_id"], x["distance"]) for x in top] == [(5, 9.0)]
