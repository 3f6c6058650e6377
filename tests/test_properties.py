"""Property tests: the OR-join rewrite equals the direct disjunctive join, and exact quantiles equal
NumPy's, on generated inputs (small, so many cases run quickly)."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from flightlake.operators import enrich as en
from flightlake.operators.quantile import exact_quantile
from test_enrich import af, direct_or_join, md, names, obs

code = st.sampled_from(["A", "B", "C", None])
key = st.sampled_from(["k1", "k2", "k3", "k4", None])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(obs_keys=st.lists(st.sampled_from(["k1", "k2", "k3", "zz", ""]), min_size=0, max_size=12),
       frames=st.lists(st.tuples(key, code, code), min_size=0, max_size=6),
       types=st.lists(st.tuples(st.sampled_from(["A", "B", "D"]), st.integers(0, 99)), min_size=0, max_size=6))
def test_or_join_rewrite_property(spark, obs_keys, frames, types):
    o = obs(spark, obs_keys)
    a = af(spark, frames)
    m = md(spark, [(d, f"n{i}") for d, i in types])
    assert names(en.enrich(o, a, m)) == names(direct_or_join(o, a, m))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=st.lists(st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)),
                       min_size=1, max_size=60),
       p=st.sampled_from([0.0, 0.01, 0.25, 0.5, 0.99, 1.0]))
def test_exact_quantile_property(spark, values, p):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert abs(exact_quantile(df, "v", p) - np.percentile(values, p * 100)) <= 1e-9 * max(1.0, max(abs(v) for v in values))
