"""Wide tables: blocked correlations, randomised PCA, sparse one-hot, ordered target statistics."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabkiln.operators import blocked, encode, profile, reduce, target_stats


def _gappy(spark, rows=300):
    rng = np.random.default_rng(5)
    x = rng.standard_normal((rows, 11))
    x[:, 4] = 1e9 + x[:, 0] * 2  # far from zero
    x[:, 5] = 3.0  # constant
    x[:, 9] = -x[:, 1] + 1e-3 * x[:, 9]
    cells = [[i] + [None if (i + j) % 5 == 0 and j % 2 else float(v) for j, v in enumerate(r)] for i, r in enumerate(x)]
    for r in cells[::7]:
        r[3] = float("nan")
    for r in cells:  # never both there
        r[7] = r[7] if r[0] % 2 else None
        r[8] = None if r[0] % 2 else r[8]
    return spark.createDataFrame(cells, "id long, " + ", ".join(f"`c.{j}` double" if j == 6 else f"c{j} double" for j in range(11)))


def _table(df):
    return {(r["pos_a"], r["pos_b"]): (r["col_a"], r["col_b"], r["corr"]) for r in df.collect()}


def _brute_correlations(df, cols):
    x = np.array([[np.nan if v is None else v for v in r] for r in df.select(*[f"`{c}`" for c in cols]).collect()], dtype=float)
    out = {}
    for b in range(len(cols)):
        for a in range(b):
            both = x[~np.isnan(x[:, [a, b]]).any(axis=1)][:, [a, b]]
            constant = not len(both) or (np.ptp(both, axis=0) == 0).any()
            out[(a, b)] = (cols[a], cols[b], None if constant else float(np.corrcoef(both, rowvar=False)[0, 1]))
    return out


def test_blocked_correlation_equals_brute_force_for_every_tile_size(spark):
    df = _gappy(spark).repartition(5)
    cols = [c for c in df.columns if c != "id"]
    want = _brute_correlations(df, cols)
    for tile in (4, 11, 512):
        got = _table(blocked.blocked_pairs(df, cols, tile))
        assert got.keys() == want.keys()
        for k, (a, b, corr) in want.items():
            assert got[k][:2] == (a, b)
            assert (got[k][2] is None) == (corr is None), (k, tile)
            assert corr is None or abs(got[k][2] - corr) < 1e-6, (k, tile)


def test_blocked_correlation_of_empty_tables_infinite_cells_and_repeated_names(spark):
    empty = spark.createDataFrame([], "a double, b long, c float")
    assert [r["corr"] for r in blocked.blocked_pairs(empty, ["a", "b", "c"]).collect()] == [None] * 3
    wild = spark.createDataFrame([(1.0, 2.0, 5), (2.0, math.inf, 6), (3.0, 1.0, 9)], "a double, b double, c long")
    got = _table(blocked.blocked_pairs(wild, ["a", "b", "c"], 2))
    assert got[(0, 1)][2] is None and got[(1, 2)][2] is None and got[(0, 2)][2] == pytest.approx(0.960769, abs=1e-6)
    with pytest.raises(ValueError):
        blocked.blocked_pairs(wild, ["a"])
    with pytest.raises(ValueError):
        blocked.blocked_pairs(wild, ["a", "a"])


def test_collinear_columns_come_from_the_pairs_above_the_threshold(spark):
    df = _gappy(spark)
    cols = [c for c in df.columns if c not in ("id", "c.6")]
    pairs = blocked.blocked_pairs(df, cols, 4)
    assert blocked.collinear_columns(pairs, 0.95) == profile.fit_collinear(df, cols, 0.95) == ["c4", "c9"]
    assert blocked.collinear_columns(pairs, 0.95, keep=["c4"]) == ["c9"]
    assert "c9" not in blocked.remove_collinear(df, cols, 0.95, tile=4).columns


def _low_rank(spark, rows=400, d=40, rank=5):
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((rows, rank)) * [9, 7, 5, 3, 2]) @ rng.standard_normal((rank, d)) + 100
    x += 0.01 * rng.standard_normal((rows, d))
    return x, spark.createDataFrame([[i, *map(float, r)] for i, r in enumerate(x)], "id long, " + ", ".join(f"m{j} double" for j in range(d)))


def test_wide_pca_matches_numpy_and_does_not_depend_on_the_layout(spark):
    x, df = _low_rank(spark)
    cols = [c for c in df.columns if c != "id"]
    model = reduce.fit_pca_wide(df, cols, 3)
    again = reduce.fit_pca_wide(df.repartition(7), cols, 3)
    assert np.allclose(model.vectors, again.vectors, atol=1e-8)
    values, vectors = np.linalg.eigh(np.cov(x, rowvar=False))
    values, vectors = values[::-1], vectors[:, ::-1]
    assert np.allclose(model.explained_variance, values[:3] / values.sum(), rtol=1e-9)
    assert np.allclose(np.abs((model.vectors * vectors[:, :3]).sum(axis=0)), 1.0, atol=1e-9)
    for plain_terms in (1000, 0):
        out = model.transform(df, ["id"], plain_terms).orderBy("id").toPandas()
        assert np.allclose(np.abs(out["pca_1"]), np.abs((x - x.mean(axis=0)) @ vectors[:, 1]), atol=1e-6)


def test_wide_pca_of_few_columns_equals_the_full_one(spark):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, rng.gauss(0, 3), rng.gauss(5, 1), rng.random()) for i in range(200)], "id long, a double, b double, c double")
    wide, full = reduce.fit_pca_wide(df, ["a", "b", "c"], 3), reduce.fit_pca(df, ["a", "b", "c"], 3)
    assert np.allclose(wide.explained_variance, full.explained_variance, rtol=1e-9)
    ours, theirs = (m.transform(df, ["id"]).orderBy("id").toPandas() for m in (wide, full))
    for i in range(3):
        assert np.allclose(np.abs(ours[f"pca_{i}"]), np.abs(theirs[f"pca_{i}"]), atol=1e-8)


def test_wide_pca_with_gaps_constants_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, None, 3.0), (3, 4.0, float("nan")), (4, 3.0, 2.0)], "id long, a double, b double")
    model = reduce.fit_pca_wide(df, ["a", "b"], 1)
    for plain_terms in (1000, 0):
        got = {r["id"]: r["pca_0"] for r in model.transform(df, ["id"], plain_terms).collect()}
        assert got[2] is None and got[3] is None and got[1] == pytest.approx(-1.0) and got[4] == pytest.approx(1.0)
    assert model.explained_variance == [pytest.approx(1.0)]
    constant = reduce.fit_pca_wide(df.select("id", F.lit(2.0).alias("a"), F.lit(1).alias("b")), ["a", "b"], 2)
    assert constant.explained_variance == [0.0, 0.0]
    empty = reduce.fit_pca_wide(df.limit(0), ["a", "b"], 1)
    assert empty.explained_variance == [0.0]
    with pytest.raises(ValueError):
        reduce.fit_pca_wide(df, ["a", "b"], 3)


def test_sparse_onehot_equals_the_dense_one(spark):
    rows = [(i, ["Red", "red ", "blue", None][i % 4], i % 7, "x") for i in range(60)]
    df = spark.createDataFrame(rows, "id long, color string, n int, _index_0 string")
    model = encode.fit_onehot_sparse(df, ["color", "n"])
    assert model.size == 9 and model.sizes == {"color": 2, "n": 7}
    dense = encode.fit_onehot(df, ["color", "n"]).transform(df).orderBy("id").collect()
    names = ["color_blue", "color_red"] + [f"n_{v}" for v in range(7)]
    sparse = {r["id"]: r["onehot"] for r in model.transform(df).collect()}
    vectors = {r["id"]: r["onehot"] for r in model.vectors(df).collect()}
    assert len(sparse) == len(vectors) == 60
    for r in dense:
        want = [i for i, n in enumerate(names) if r[n]]
        assert sparse[r["id"]] == want
        assert len(vectors[r["id"]]) == 9 and [i for i, v in enumerate(vectors[r["id"]].toArray()) if v] == want


def test_sparse_onehot_of_unknown_values_many_values_and_empty_columns(spark):
    df = spark.range(5000).select("id", F.col("id").cast("string").alias("v"), F.lit(None).cast("string").alias("none"))
    model = encode.fit_onehot_sparse(df, ["none", "v"])
    assert model.sizes == {"none": 0, "v": 5000}
    new = spark.createDataFrame([(1, "7", "z"), (2, "nowhere", None)], "id long, v string, none string")
    assert {r["id"]: len(r["onehot"]) for r in model.transform(new).collect()} == {1: 1, 2: 0}
    got = {r["id"]: r["onehot"] for r in model.vectors(new).collect()}
    assert got[1].numNonzeros() == 1 and got[2].numNonzeros() == 0 and got[2].size == 5000
    empty = encode.fit_onehot_sparse(df.limit(0), ["v"])
    assert empty.size == 0 and empty.transform(df.limit(3)).filter("size(onehot) = 0").count() == 3
    with pytest.raises(ValueError):
        model.transform(df.withColumn("onehot", F.lit(1)))


def _brute(rows, seed, weight, prior):
    import hashlib

    done, out = {}, {}
    for i, c, y in sorted(rows, key=lambda r: (hashlib.md5(f"{seed}:{r[0]}".encode()).hexdigest(), r[0])):
        n, s = done.get(c, (0, 0.0))
        out[i] = (s + weight * prior) / (n + weight) if n + weight else prior
        if y is not None and not math.isnan(y):
            done[c] = (n + 1, s + y)
    return out


@pytest.mark.parametrize("per_range", [2_000_000, 200_000])
@pytest.mark.parametrize("weight", [1.0, 0.0])
def test_ordered_target_stats_equal_brute_force(spark, per_range, weight):
    rng = random.Random(1)
    rows = [(i, None if i % 9 == 0 else "hot" if i % 2 else f"c{rng.randrange(40)}", None if i % 13 == 0 else rng.random()) for i in range(3000)]
    rows[5] = (5, "hot", float("nan"))
    df = spark.createDataFrame(rows, "id long, c string, y double").withColumn("_first", F.lit(1)).repartition(6)
    labels = [y for _, _, y in rows if y is not None and not math.isnan(y)]
    want = _brute(rows, 3, weight, sum(labels) / len(labels))
    out = target_stats.ordered_target_stats(df, "c", "y", "id", seed=3, weight=weight, rows_per_bucket=per_range // 2000)
    assert out.columns == ["id", "c", "y", "_first", "c_stat"]
    got = {r["id"]: r["c_stat"] for r in out.collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[i] - want[i]) for i in want) < 1e-9


def test_a_row_does_not_see_its_own_label(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("c"), (F.col("id") % 2).alias("y"))
    moved = df.withColumn("y", F.when(F.col("id") == 77, 1000).otherwise(F.col("y")))
    a, b = ({r["id"]: r["c_stat"] for r in target_stats.ordered_target_stats(t, "c", "y", "id", prior=0.5).collect()} for t in (df, moved))
    assert a[77] == b[77] and a != b
    assert all(a[i] == b[i] for i in a if i % 3 != 77 % 3)


def test_target_stats_of_new_rows_empty_tables_and_no_labels(spark):
    train = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.0), (3, None, 1.0), (4, "b", None)], "id long, c string, y double")
    test = spark.createDataFrame([(1, "a"), (2, None), (3, "b"), (4, "new")], "id long, c string")
    _, scored = target_stats.encode_train_test(train, test, ["c"], "y", "id")
    prior = 2 / 3
    want = {1: (1 + prior) / 3, 2: (1 + prior) / 2, 3: prior, 4: prior}
    assert {r["id"]: r["c_stat"] for r in scored.collect()} == pytest.approx(want)
    assert target_stats.ordered_target_stats(train.limit(0), "c", "y", "id").count() == 0
    bare = target_stats.ordered_target_stats(train.withColumn("y", F.lit(None).cast("double")), "c", "y", "id")
    assert {r["c_stat"] for r in bare.collect()} == {0.0}
    with pytest.raises(ValueError):
        target_stats.ordered_target_stats(train.withColumn("c_stat", F.lit(1)), "c", "y", "id")
