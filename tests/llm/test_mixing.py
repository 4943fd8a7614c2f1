import math
from collections import Counter

from wordmill.llm import mixing
from wordmill.llm.queries import ORACLE, op1_mix_sources
from tests.llm.conftest import SF
from tests.oracle_check import connect, rows_of


def test_equals_sql(spark):
    df = op1_mix_sources(spark, SF)
    result = connect(SF).execute(ORACLE["op1_mix_sources"])
    columns = [c[0] for c in result.description]
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_no_python_in_the_plan(spark):
    plan = op1_mix_sources(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_inversion_of_small_and_large_rates(spark):
    rates = spark.createDataFrame([(r,) for r in (0.01, 1.0, 30.0, 199.0, 201.0, 5000.0)], "rate double")
    for r in rates.select("rate", mixing.poisson_steps(rates.rate).alias("s")).collect():
        total = 0.0
        cdf = {}
        for k in range(int(r.rate + 14 * math.sqrt(r.rate) + 40)):
            total += math.exp(k * math.log(r.rate) - r.rate - math.lgamma(k + 1))
            cdf[k] = total
        for i, c in enumerate(r.s.cdf):
            assert abs(c - cdf.get(r.s.first + i, 1.0)) < 1e-9
        assert r.s.cdf[0] < 1e-12 or r.s.first == 0


def test_rates_nulls_ties_and_clashing_names(spark, frame):
    rows = [(i, "t", "big") for i in range(3000)] + [(None, None, None)] * 2 + [(7, "", "small")] * 500
    docs = frame(rows, copy="mine", steps="mine", u="x")
    weights = spark.createDataFrame([("big", 3000, 1.0), ("small", 500, 1.0), (None, 2, 2.0)], "source string, n_rows long, weight double")
    got = mixing.mix(docs, weights).collect()
    by = Counter(r.source for r in got)
    assert abs(by["big"] - 3502 / 4) < 120  # a quarter of the mixture, within four deviations
    assert by["small"] % 500 == 0  # equal keys, equal counts
    assert by[None] % 2 == 0 and by[None] > 1000
    assert {(r.steps, r.u) for r in got} == {("mine", "x")}
    assert mixing.mix(docs.limit(0), weights.limit(0)).count() == 0
    assert {r.source for r in mixing.mix(docs, weights.filter("source = 'big'")).collect()} == {"big"}
