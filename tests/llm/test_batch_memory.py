"""How much text a worker is handed at a time."""

from __future__ import annotations

import pytest

from procurelens.llm import store


@pytest.fixture
def unset(spark):
    before = spark.conf.get(store.BATCH)
    spark.conf.unset(store.BATCH)
    yield
    spark.conf.set(store.BATCH, before)


def sizes(spark):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], names=["n", "size"])

    texts = spark.range(0, 6000, 1, 1).selectExpr("id", "repeat(cast(id % 10 as string), 4000) text")
    return [tuple(r) for r in texts.mapInArrow(run, "n long, size long").collect()]


def test_batches_of_long_texts_are_small(spark, unset):
    store.ship(spark)
    found = sizes(spark)
    assert sum(n for n, _ in found) == 6000 and max(size for _, size in found) < 2 * store.BATCH_BYTES


def test_a_bound_of_the_session_stays(spark, unset):
    spark.conf.set(store.BATCH, str(1 << 20))
    store.ship(spark)
    assert max(size for _, size in sizes(spark)) < 2 << 20
