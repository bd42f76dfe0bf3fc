"""A stream that corrects itself when an earlier document comes later."""

import random

import pytest

from lexcorpus.operators.dedup import keep_first
from lexcorpus.streaming import ingest

SCHEMA = "ord long, document_id string, title string, replaces_ string"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocks(spark):
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(PROVIDER)


def streamed(spark, folder, batches):
    """What the stream gave out for batches of rows, stopped and started again before each."""
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(f"{folder}/in")
        given = ingest.first_in_order(spark.readStream.schema(SCHEMA).json(f"{folder}/in"))
        job = given.writeStream.format("parquet").option("checkpointLocation", f"{folder}/state")
        job.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.parquet(f"{folder}/out")


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrival_ends_like_the_batch_rule(rocks, tmp_path, seed):
    rng = random.Random(seed)
    keys = ["a", "b", "c", "", None, "k", "o3"]
    rows = [(i, rng.choice(keys), rng.choice([None, "", f"t{i}"]), None) for i in range(40)]
    mixed = rng.sample(rows, len(rows))
    given = streamed(rocks, tmp_path, [mixed[:9], mixed[9:10], mixed[10:30], mixed[30:]])
    want = keep_first(rocks.createDataFrame(rows, SCHEMA), ["document_id"])
    as_rows = lambda df: sorted(tuple(r[c] for c in SCHEMA.replace(" long", "").replace(" string", "").split(", ")) for r in df.collect())
    got = ingest.settled(given)
    assert got.columns == ["ord", "document_id", "title", "replaces_"]
    firsts = {}
    for row in rows:
        firsts.setdefault(row[1], row)
    assert as_rows(got) == as_rows(want) == sorted(firsts.values())
    chain = [(r["ord"], r["replaces"]) for r in given.collect()]
    assert len({o for o, _ in chain}) == len(chain) and all(p is None or p > o for o, p in chain)
