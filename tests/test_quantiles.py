import numpy as np
import pytest

from rareclass.functions.quantiles import exact_quantiles

PROBS = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]


@pytest.mark.parametrize("leaf", [1, 20, 1_000_000])
def test_exact_for_skewed_tied_and_missing_values(spark, leaf):
    rng = np.random.default_rng(5)
    n = 4000
    data = {
        "even": rng.normal(size=n), "heavy": np.where(rng.random(n) < 0.4, 0.0, rng.lognormal(0, 6, n)),
        "few": rng.integers(0, 3, n).astype(float), "same": np.full(n, 7.0),
        "gaps": np.where(rng.random(n) < 0.5, np.nan, rng.normal(size=n))}
    label = (rng.random(n) < 0.05).astype(int)
    rows = [(int(label[i]), *[None if np.isnan(v[i]) else float(v[i]) for v in data.values()], None) for i in range(n)]
    df = spark.createDataFrame(rows, "Class int, even double, heavy double, few double, same double, gaps double, none double")
    got = exact_quantiles(df, [*data, "none"], PROBS, "Class", leaf_rows=leaf, sample_rows=200)
    for g in (0, 1):
        for c, v in data.items():
            x = v[label == g]
            x = x[~np.isnan(x)]
            for p in PROBS:
                assert got[(g, c, p)] == pytest.approx(np.quantile(x, p), rel=1e-12, abs=1e-15), (g, c, p)
        assert got[(g, "none", 0.5)] is None
    whole = exact_quantiles(df, ["even"], [0.5], leaf_rows=leaf, sample_rows=200)
    assert whole[(None, "even", 0.5)] == pytest.approx(np.median(data["even"]))
