"""Property: top-k and full ranks equal a brute-force computation in Python
on random data with hot keys, ties and a NULL period."""

from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import sorted_rows
from tidelog.operators.topk import rank_counts, top_k_per_group

periods = st.sampled_from(["d1", "d2", "d3", None])
keys = st.sampled_from([f"k{i}" for i in range(12)])


def _expected(rows, k=None):
    counts = Counter(rows)
    by_period: dict = {}
    for (p, key), n in counts.items():
        by_period.setdefault(p, []).append((key, n))
    out = []
    for p, items in by_period.items():
        items.sort(key=lambda kv: (-kv[1], kv[0]))
        for rank, (key, n) in enumerate(items, start=1):
            if k is None:
                out.append((p, key, n, rank))
            elif rank <= k:
                out.append((p, key, n))
    return sorted(out, key=lambda t: tuple((v is not None, str(v)) for v in t))


@settings(max_examples=3, deadline=None)
@given(
    st.lists(st.tuples(periods, keys), min_size=1, max_size=400),
    st.lists(st.tuples(periods, keys), max_size=1),
    st.integers(1, 6),
)
def test_top_k_and_ranks_match_brute_force(spark, rows, hot, k):
    rows = rows + hot * 200  # one hot (period, key) pair
    df = spark.createDataFrame(rows, "p string, key string")
    assert sorted_rows(top_k_per_group(df, "p", "key", k)) == _expected(rows, k)
    ranked = rank_counts(df, "p", "key")
    assert sorted_rows(ranked.select("p", "key", "request_count", "rn")) == _expected(rows)
