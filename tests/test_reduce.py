"""PCA against a NumPy eigen-decomposition of the centred covariance."""

import numpy as np

from tabkiln.operators import reduce
from tabkiln.plans import fixtures as fx

from conftest import SF


def test_pca_matches_numpy(spark):
    r = fx.reg(spark, SF).select("id", "x1", "x3", "c1").orderBy("id")
    cols = ["x1", "x3", "c1"]
    res = reduce.fit_pca(r, cols, 2)
    out = res.transform(r, keep=["id"]).orderBy("id").toPandas()
    x = r.toPandas()[cols].to_numpy(dtype=float)
    xc = x - x.mean(axis=0)
    vals, vecs = np.linalg.eigh(np.cov(xc, rowvar=False))
    order = np.argsort(vals)[::-1]
    ratio = vals[order] / vals.sum()
    assert np.allclose(res.explained_variance, ratio[:2], rtol=1e-6, atol=1e-9)
    proj = xc @ vecs[:, order[:2]]
    for i in range(2):
        got = out[f"pca_{i}"].to_numpy()
        sign = np.sign(np.dot(got, proj[:, i])) or 1.0  # component signs are arbitrary
        assert np.allclose(got * sign, proj[:, i], rtol=1e-6, atol=1e-6)
