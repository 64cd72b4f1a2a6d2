"""Id selection and request planning."""

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerline.operators import ids as I


def test_sync_gap_edges(spark):
    pages = lambda total, loaded: [r.page for r in I.sync_gap(spark, total, loaded, 100).collect()]
    assert pages(100, 100) == []
    assert pages(50, 100) == []
    assert pages(150, 100) == [1]
    assert pages(300, 100) == [3, 2, 1]     # a multiple of 100 asks one page more
    assert pages(301, 100) == [3, 2, 1]


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=-10**6, max_value=10**6), max_size=300),
       st.integers(min_value=1, max_value=60))
def test_chunks_concatenate_back(spark, values, size):
    df = spark.createDataFrame([(v,) for v in values], "id bigint")
    chunks = sorted(I.chunk_ids(df, "id", size).collect(), key=lambda r: r.chunk)
    ids = [int(x) for r in chunks for x in r.ids.split(",")]
    assert ids == sorted(set(values))
    assert [r.chunk for r in chunks] == list(range(len(chunks)))
    assert all(len(r.ids.split(",")) == size for r in chunks[:-1])


def test_request_grid_has_24_per_chunk(spark):
    df = spark.createDataFrame([(i,) for i in range(120)], "id bigint")
    grid = I.request_grid(I.chunk_ids(df, "id", 50))
    assert grid.count() == 3 * 24
    assert grid.select("integration_type", "include_disregarded", "include_organic") \
               .distinct().count() == 24


def test_per_id_requests_empty(spark):
    df = spark.createDataFrame([], "id bigint")
    assert I.per_id_requests(df, "id", "/x/%s").count() == 0


def test_live_ids(spark):
    df = spark.createDataFrame([(1, "live"), (1, "live"), (None, "live"), (2, "draft")],
                               "id bigint, statusString string")
    assert [r.id for r in I.live_ids(df, "id").collect()] == [1]
