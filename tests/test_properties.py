"""Property checks: dedupe equals a brute-force winner whatever
the partitioning; class counts add up to the labelled rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from barrio.operators.dedupe import keep_one
from barrio.operators.label import label_by_quantiles

ROWS = st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(-3, 3)),
                          st.sampled_from(["a", "b", "c"])), min_size=1, max_size=40)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _brute_min(rows):
    """Per key: smallest (v, s) with nulls last -- the documented winner."""
    best = {}
    for k, v, s in rows:
        rank = (v is None, v if v is not None else 0, s)
        if k not in best or rank < best[k][0]:
            best[k] = (rank, (k, v, s))
    return sorted(r for _, r in best.values())


@SETTINGS
@given(rows=ROWS, parts=st.integers(1, 6))
def test_keep_one_matches_brute_force(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, v int, s string").repartition(parts)
    got = sorted(tuple(r) for r in keep_one(df, ["k"], ["v"]).collect())
    assert got == _brute_min(rows)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.floats(0, 1000, allow_nan=False)), min_size=3, max_size=60))
def test_class_counts_sum_to_labelled_rows(spark, values):
    if sum(v is not None for v in values) == 0:
        return
    df = spark.createDataFrame([(v,) for v in values], "p double")
    out, cuts = label_by_quantiles(df, "p", relative_error=0.0)
    counts = {r[0]: r[1] for r in out.groupBy("price_category").count().collect()}
    assert sum(counts.values()) == sum(v is not None for v in values)
    assert set(counts) <= {0.0, 1.0, 2.0} and cuts == sorted(cuts)


@SETTINGS
@given(start=st.integers(0, 1000), step=st.integers(-60, 60), n=st.integers(2, 6), ahead=st.integers(1, 6))
def test_zero_noise_projection_is_linear_until_clamped(spark, start, step, n, ahead):
    from barrio.operators.forecast import projected_rows
    years = list(range(2010, 2010 + n))
    hist = [(y, float(start + i * step)) for i, y in enumerate(years)]
    df = spark.createDataFrame([(1, [(y, v) for y, v in hist])],
                               "_id int, info array<struct<year:int, Amount:double>>")
    out = projected_rows(df, end_year=years[-1] + ahead, variance=0.0, secondary_threshold=1.0)
    got = [(r["year"], r["Amount"]) for r in out.orderBy("year").collect()]
    last = hist[-1][1]
    assert got == [(years[-1] + k, max(0.0, last + k * step)) for k in range(1, ahead + 1)]
