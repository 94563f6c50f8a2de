import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows
from strainwise.functions import intervals, numeric, text
from strainwise.sources.sinks import json_number


@pytest.mark.parametrize(
    "value, lower, expected",
    [
        ("(2,5 , 5,0]", None, "(2.5,5.0]"),
        ("5", 2.5, "(2.5,5]"),
        ("5", None, "[5.0,5.0]"),
        ("0,25", None, "[0.25,0.25]"),
        (".5", None, "[0.5,0.5]"),
        ("0.0005", None, "[0.0005,0.0005]"),
        ("<=0.5", None, "(0,0.5]"),
        ("≤ 0,5", None, "(0,0.5]"),
        ("<0.5", None, "(0,0.5)"),
        (">8", None, "(8.0,)"),
        (">=8", None, "[8.0,)"),
        ("≥8", None, "[8.0,)"),
        ("2.5-5", None, "(2.5,5]"),
        ("2,5or5", None, "(2.5,5]"),
        ("2.5/5", None, "(2.5,5]"),
        ("[1,1]", 0.5, "[1,1]"),
        ("contaminated", None, "contaminated"),
    ],
)
def test_mic_text(frame, value, lower, expected):
    df = frame([(value, lower)], "v string, l double")
    assert df.select(intervals.canonical_interval(F.col("v"), F.col("l"))).first()[0] == expected


def test_interval_bounds(frame):
    df = frame([("(0.5,1]",), ("(2,)",), ("(,0.5]",), ("free text",)], "v string")
    found = [tuple(r) for r in df.select(intervals.lower_bound(F.col("v")), intervals.upper_bound(F.col("v"))).collect()]
    assert found == [(0.5, 1.0), (2.0, None), (None, 0.5), (None, None)]


def test_beta_quantile_closed_forms():
    n = np.array([1.0, 5, 50, 5000])
    # One shape equal to 1 has a closed form.
    assert np.allclose(numeric.beta_quantile(0.975, np.ones(4), n), 1 - 0.025 ** (1 / n), atol=1e-12)
    assert np.allclose(numeric.beta_quantile(0.975, n, np.ones(4)), 0.975 ** (1 / n), atol=1e-12)
    assert np.isnan(numeric.beta_quantile(0.975, np.array([3.0]), np.array([0.0])))[0]


def test_beta_cdf_is_binomial_tail():
    for r, s, x in [(0, 7, 0.3), (3, 10, 0.2), (40, 60, 0.5), (200, 1800, 0.11), (90000, 10000, 0.899)]:
        n = r + s
        terms = [
            math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(x) + (n - k) * math.log1p(-x))
            for k in range(r + 1)
        ]
        assert abs((1 - math.fsum(terms)) - float(numeric.beta_cdf(x, r + 1.0, float(s)))) < 1e-8


def test_upper_bound_column_has_nan_without_susceptible(frame):
    df = frame([(3, 0), (0, 10)], "R long, S long")
    values = [r[0] for r in df.select(numeric.clopper_pearson_upper(F.col("R"), F.col("S"))).collect()]
    assert math.isnan(values[0]) and abs(values[1] - (1 - 0.025 ** 0.1)) < 1e-12


def test_allele_fraction_rounds_half_even_and_survives_zero(frame):
    df = frame([(1, 8), (23, 40), (3, 8), (1, 0)], "alternative_ad int, total_dp int")
    assert [r[0] for r in df.select(numeric.allele_fraction()).collect()] == [0.12, 0.58, 0.38, None]


def test_codon(frame):
    df = frame([(1,), (3,), (4,), (1278,)], "d int")
    assert [r[0] for r in df.select(numeric.codon_of(F.col("d"))).collect()] == [1, 1, 2, 426]


@pytest.mark.parametrize(
    "value, expected",
    [
        (0.0, "0"),
        (0.5, "0.5"),
        (100.0, "100"),
        (12340.0, "12340"),
        (123456.0, "1.2346e+05"),
        (100000.0, "1e+05"),
        (0.0001, "0.0001"),
        (0.000012345678, "1.2346e-05"),
        (float("nan"), '"NaN"'),
        (float("inf"), '"Infinity"'),
        (float("-inf"), '"-Infinity"'),
        (None, "null"),
    ],
)
def test_json_number(frame, value, expected):
    assert frame([(value,)], "v double").select(json_number(F.col("v"))).first()[0] == expected


def test_texts_are_ordered(frame):
    df = frame([(1, 2, "b"), (1, 1, "c"), (1, 3, "b"), (1, 4, None)], "k int, o int, v string")
    out = df.groupBy("k").agg(text.set_text(F.col("v"), ";"), text.ordered_text(F.col("o"), F.col("v"), ";"))
    assert rows(out) == [(1, "b;c", "c;b;b")]


def test_critical_counts_agree_with_the_bound():
    """From the critical S on, and not before, the upper bound lies below the threshold."""
    resistant = np.array([0, 1, 2, 3, 10, 57, 1000, 20_000])
    for threshold in (0.05, 0.1, 0.5, 0.9):
        least = numeric.critical_susceptible(resistant, threshold)
        assert (np.diff(least) >= 0).all() and (least >= 1).all()
        assert (numeric.beta_quantile(0.975, resistant + 1.0, least.astype(float)) < threshold).all()
        before = np.maximum(least - 1, 1).astype(float)
        assert ((numeric.beta_quantile(0.975, resistant + 1.0, before) >= threshold) | (least == 1)).all()
    with pytest.raises(ValueError):
        numeric.critical_susceptible(resistant, 1.0)
