import numpy as np
import pytest

from reachset.llm.packing import place

from .test_tokens import best_fit_decreasing


@pytest.mark.parametrize("low, high, n", [(50, 500, 1500), (20, 400, 1500)])
def test_items_of_bundles_fill_the_last_gaps(spark, low, high, n):
    sizes = np.random.default_rng(3).integers(low, high + 1, n).tolist()
    items = spark.createDataFrame(list(enumerate(sizes)), "id long, size int")
    rows = place(items, 4096).collect()
    assert sorted(r.id for r in rows) == list(range(n))
    ends = {}
    for r in sorted(rows, key=lambda r: (r.bin, r.at)):
        assert r.at >= ends.get(r.bin, 0)
        ends[r.bin] = r.at + sizes[r.id]
    assert max(ends.values()) <= 4096
    assert len(ends) <= 1.01 * best_fit_decreasing(sizes, 4096) + 1
