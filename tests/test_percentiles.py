import numpy as np
import pytest

from panelforge.operators.percentiles import exact_percentiles

PS = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}


@pytest.fixture(scope="module")
def values():
    draw = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in draw.normal(size=3000)]
    rows += [("few", float(v)) for v in draw.integers(0, 4, size=50)]
    rows += [("one", 3.5), ("hot", None)]
    return rows


@pytest.mark.parametrize("accuracy", [100, 10_000])
@pytest.mark.parametrize("interpolate", [False, True])
def test_exact(spark, values, accuracy, interpolate):
    """Also with a sketch much coarser than the group."""
    df = spark.createDataFrame(values, "k string, v double")
    got = {
        r["k"]: r for r in exact_percentiles(df, ["k"], "v", PS, interpolate, accuracy).collect()
    }
    for key in ("hot", "few", "one"):
        x = [v for k, v in values if k == key and v is not None]
        for name, p in PS.items():
            want = np.quantile(x, p, method="linear" if interpolate else "inverted_cdf")
            assert got[key][name] == pytest.approx(want, abs=1e-12), (key, name)


def test_whole_table(spark, values):
    df = spark.createDataFrame(values, "k string, v double")
    got = exact_percentiles(df, [], "v", {"m": 0.5}, True, 100).first()["m"]
    assert got == pytest.approx(np.median([v for _, v in values if v is not None]))


def test_brackets_are_narrowed(spark, monkeypatch):
    """A key with very many values, far outliers and ties; a NULL key."""
    from panelforge.operators import percentiles

    monkeypatch.setattr(percentiles, "RANKED", 40)
    draw = np.random.default_rng(8)
    many = [*draw.normal(size=8000), *[1e9, -1e12], *[0.25] * 500]
    rows = [("hot", float(v)) for v in many] + [(None, float(v)) for v in draw.normal(size=300)]
    df = spark.createDataFrame(rows, "k string, v double")
    for interpolate in (False, True):
        got = {r["k"]: r for r in exact_percentiles(df, ["k"], "v", PS, interpolate, 100).collect()}
        for key in ("hot", None):
            x = [v for k, v in rows if k == key]
            for name, p in PS.items():
                want = np.quantile(x, p, method="linear" if interpolate else "inverted_cdf")
                assert got[key][name] == pytest.approx(want, rel=1e-12), (key, name)


def test_limits_of_a_null_key_agree(spark):
    from panelforge.operators.scores import with_flow_limits

    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 3.0)], "country string, net_imports double")
    one, two = (
        sorted(map(str, with_flow_limits(df, ["country"], one_row_per_period=way).select("country", "net_imports", "P10_net", "P90_net").collect()))
        for way in (True, False)
    )
    assert one == two
