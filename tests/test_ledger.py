"""The sealed ledger as a stream: late, repeated and early events, seals and expiry, across restarts."""

import pytest

from skein.streaming import ledger

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
SCHEMA = "attempt_id string, seq long, event_id string, event_type string, t string"


@pytest.fixture
def rocks(spark):
    had = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.set(PROVIDER, had)


def test_a_ledger_across_restarts(rocks, tmp_path):
    seen: dict[tuple, list[str]] = {}

    def feed(*rows):
        d = rocks.createDataFrame([(a, s, f"{a}{s}{x}", k, f"2024-01-01 {t}") for a, s, x, k, t in rows], SCHEMA).selectExpr("attempt_id", "seq", "event_id", "event_type", "cast(t as timestamp) as ts")
        d.coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        s = ledger.sealed_ledger(rocks.readStream.schema(d.schema).parquet(f"{tmp_path}/in"), delay="1 minute", wait=600, keep=1200)
        s.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination(120)
        got = sorted((r.event_id, r.status) for r in rocks.read.schema(ledger.STATUSES).parquet(f"{tmp_path}/out").collect())
        new = list(got)
        for x in seen.get((), []):
            new.remove(x)
        seen[()] = got
        return new

    step, end = "TOOL_CALL", "FINAL_OUTPUT"
    assert feed(("a", 0, "", step, "10:00:00"), ("a", 2, "", step, "10:00:01"), ("b", 1, "", end, "10:00:02")) == [("a0", "APPENDED")]
    assert feed(("a", 1, "", step, "10:00:03"), ("a", 0, "x", step, "10:00:03"), ("a", 2, "y", step, "10:00:03")) == [("a0x", "REPEATED"), ("a1", "APPENDED"), ("a2", "APPENDED"), ("a2y", "REPEATED")]
    assert feed(("a", 3, "", end, "10:01:00"), ("a", 5, "", step, "10:01:00")) == [("a3", "APPENDED"), ("a5", "AFTER_SEAL")]
    assert feed(("a", 4, "", step, "10:02:00")) == [("a4", "AFTER_SEAL")]
    # b's event 0 never comes: an hour on, its tail is given out; a is forgotten
    feed(("c", 0, "", step, "11:30:00"))
    feed(("c", 1, "", step, "11:30:01"))
    every = dict(seen[()])
    assert every["b1"] == "INCOMPLETE" and every["c0"] == every["c1"] == "APPENDED" and len(every) == len(seen[()])
