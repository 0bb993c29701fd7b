"""Property tests for the rewrites the plans rely on.

Each example set is evaluated in ONE Spark job (a DataFrame of generated rows),
compared with an independent formulation.
"""

from datetime import datetime, timedelta
from fractions import Fraction

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripflow.functions.columns import in_range, pct_half_up
from tripflow.plans.oracle import r2
from tripflow.specs import QualitySpec

STAMPS = st.lists(
    st.datetimes(min_value=datetime(2021, 11, 1), max_value=datetime(2024, 2, 1)), min_size=1, max_size=60
)


@settings(max_examples=12, deadline=None, derandomize=True)
@given(stamps=STAMPS, year=st.integers(2022, 2023), first=st.integers(1, 12), span=st.integers(0, 11))
def test_range_rewrite_equals_year_month_predicate(spark, stamps, year, first, span):
    last = min(12, first + span)
    q = QualitySpec(year=year, first_month=first, last_month=last)
    start, end = q.window()
    # boundary instants around the window ends are always included
    edges = [datetime.combine(start, datetime.min.time()), datetime.combine(end, datetime.min.time())]
    stamps = stamps + [e + timedelta(microseconds=d) for e in edges for d in (-1, 0, 1)]
    df = spark.createDataFrame([(s,) for s in stamps], "s timestamp_ntz")
    rows = df.select(
        in_range("s", start, end).alias("by_range"),
        ((F.year("s") == year) & F.month("s").between(first, last)).alias("by_parts"),
    ).collect()
    assert all(r.by_range == r.by_parts for r in rows)


def _half_up(part: int, whole: int) -> float:
    if whole <= 0:
        return 0.0
    x = Fraction(part * 100, whole) * 100
    return float(int(x + Fraction(1, 2))) / 100  # floor(x + 1/2) for x >= 0


@settings(max_examples=10, deadline=None, derandomize=True)
@given(pairs=st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=80))
def test_pct_half_up_is_exact(spark, pairs):
    pairs = [(min(p, w), w) for p, w in pairs]
    df = spark.createDataFrame(pairs, "p long, w long")
    got = [r.x for r in df.select(pct_half_up("p", "w").alias("x")).collect()]
    assert got == [_half_up(p, w) for p, w in pairs]


@settings(max_examples=8, deadline=None, derandomize=True)
@given(values=st.lists(
    st.one_of(
        st.floats(min_value=-1e9, max_value=1e9, allow_nan=False, allow_infinity=False),
        st.integers(-10**6, 10**6).map(lambda i: i / 1000 + 0.005),  # decimal ties
    ),
    min_size=1, max_size=60,
))
def test_duckdb_rounding_matches_spark(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    spark_r = {r.i: r.x for r in df.select("i", F.round("v", 2).alias("x")).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INTEGER, v DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    duck_r = dict(con.execute(f"SELECT i, {r2('v')} FROM t").fetchall())
    assert spark_r == duck_r
