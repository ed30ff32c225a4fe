import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from candleflow import schemas
from candleflow.operators.clean import to_silver
from candleflow.operators.features import features
from candleflow.operators.ml import fit
from candleflow.operators.split import chrono_split, train_test
from candleflow.plans.catalogue import q_features, q_stream_features, q_stream_features_out_of_order
from candleflow.sources.events import bars_from_events
from candleflow.streaming import incremental
from candleflow.streaming.incremental import (
    CompactedBatchError, IncrementalFeatures, MissingStateError, compact_state, read_features, start_scoring)
from candleflow.streaming.ingest import dedup_stream, events_stream, kline_stream, read_bars, start_bars
from frames import SF_SMALL, candle, frame


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_stream_equals_batch(spark):
    assert _rows(q_stream_features(spark, SF_SMALL)) == _rows(q_features(spark, SF_SMALL))


def test_out_of_order_equals_batch(spark):
    assert _rows(q_stream_features_out_of_order(spark, SF_SMALL)) == _rows(q_features(spark, SF_SMALL))


def _stream(spark, tag, batches):
    d = tempfile.mkdtemp(prefix=tag, dir="/tmp")
    fn = IncrementalFeatures(f"{d}/out", f"{d}/silver")
    for k, rows in enumerate(batches):
        fn(frame(spark, rows), k)
    return d, fn


def test_late_lagging_and_revised_candles_are_merged(spark):
    first = [candle("S", m, 10.0 + m) for m in (*range(15), 30)]
    second = [candle("S", 20, 5.0), *[candle("S", m, 10.0 + m) for m in range(40, 52)]]  # 20 is older than 30
    other = [candle("T", m, 1.0 + m) for m in range(14)]  # a symbol that lags behind all others
    revised = list(candle("S", 41, 77.0))
    revised[schemas.SILVER_COLUMNS.index("number_of_trades")] += 5
    stale = list(candle("S", 42, 99.0))
    stale[schemas.SILVER_COLUMNS.index("number_of_trades")] -= 1
    d, fn = _stream(spark, "incr-", [first, second, [], other, [tuple(revised), tuple(stale)]])
    final = [c for c in first + second + other if (c[0], c[1]) != (revised[0], revised[1])] + [tuple(revised)]
    want = _rows(features(frame(spark, final)))
    assert _rows(read_features(spark, f"{d}/out")) == want
    # a retried batch overwrites itself
    fn(frame(spark, [tuple(revised), tuple(stale)]), 4)
    assert _rows(read_features(spark, f"{d}/out")) == want
    # so does the same poll once more; it changes nothing
    fn(frame(spark, second), 5)
    assert _rows(read_features(spark, f"{d}/out")) == want
    assert [f for f in os.listdir(f"{d}/silver/batch_id=5") if "bucket" in f] == []


def test_missing_state_is_an_error(spark):
    d, fn = _stream(spark, "incr-gone-", [[candle("S", m, 10.0) for m in range(12)]])
    with pytest.raises(MissingStateError):
        fn(frame(spark, [candle("S", 20, 1.0)]), 2)


DAY = 24 * 60


def _hours(symbol, first_day, days, close):
    return [candle(symbol, first_day * DAY + h * 60, close + h * 0.5) for h in range(days * 24)]


def test_a_batch_reads_only_what_lies_near_its_changes(spark):
    """Forty days are stored; a backfilled candle of day 10 and a new one on
    day 40 need the days around them and none in between."""
    d = tempfile.mkdtemp(prefix="incr-near-", dir="/tmp")
    fn = IncrementalFeatures(f"{d}/out", f"{d}/silver")
    history = [c for k, c in enumerate(_hours("S", 0, 40, 5.0) + _hours("T", 0, 40, 9.0)) if k != 10 * 24 + 7]
    fn(frame(spark, history), 0)
    batch = [candle("S", 10 * DAY + 7 * 60, 77.0), candle("S", 40 * DAY, 3.0)]
    fn(frame(spark, batch), 1)
    first = min(int(f.rpartition("=")[2]) for f in os.listdir(f"{d}/silver/batch_id=0") if "bucket" in f)
    read = {int(f.rpartition("=")[2]) - first for f in fn.folders_read}
    assert read == {9, 10, 11, 39}
    rows = spark.read.parquet(f"{d}/out/batch_id=1")
    assert rows.count() == 20 + 11 and rows.select("symbol").distinct().count() == 1
    assert _rows(read_features(spark, f"{d}/out")) == _rows(features(frame(spark, history + batch)))


def test_sparse_symbols_reach_over_many_buckets(spark):
    """With a candle a day the 19 rows around a change span as many buckets."""
    rows = [candle("S", k * DAY, 10.0 + k) for k in range(60) if k != 30]
    d, fn = _stream(spark, "incr-sparse-", [rows])
    fn(frame(spark, [candle("S", 30 * DAY, 5.0)]), 1)
    assert len(fn.folders_read) == 38
    assert _rows(read_features(spark, f"{d}/out")) == _rows(features(frame(spark, [*rows, candle("S", 30 * DAY, 5.0)])))


def test_compaction_between_batches(spark):
    parts = [_hours("S", 0, 3, 1.0), _hours("S", 5, 2, 2.0) + _hours("T", 1, 2, 3.0), _hours("S", 3, 1, 4.0), _hours("S", 20, 2, 5.0)]
    d, fn = _stream(spark, "incr-compact-", parts[:3])
    out, state = f"{d}/out", f"{d}/silver"
    before = _rows(read_features(spark, out))
    assert compact_state(spark, out, state) == 1 and compact_state(spark, out, state) == 1
    assert [f for f in sorted(os.listdir(state)) if "batch" in f] == ["batch_id=2"]
    assert _rows(read_features(spark, out)) == before
    fn(frame(spark, parts[2]), 2)  # the newest batch may come again, an older one may not
    with pytest.raises(CompactedBatchError):
        fn(frame(spark, parts[1]), 1)
    revised = list(candle("S", 60, 99.0))
    revised[schemas.SILVER_COLUMNS.index("number_of_trades")] += 1
    fn(frame(spark, [*parts[3], tuple(revised)]), 3)
    fn(frame(spark, []), 4)
    final = [c for c in sum(parts, []) if (c[0], c[1]) != (revised[0], revised[1])] + [tuple(revised)]
    want = _rows(features(frame(spark, final)))
    assert _rows(read_features(spark, out)) == want
    kept = f"{state}/_base/version=1/rows"
    far = max(int(f.rpartition("=")[2]) for f in os.listdir(kept) if "bucket" in f)
    assert compact_state(spark, out, state) == 3
    assert f"bucket={far}" in os.listdir(kept)  # untouched since, so still there
    assert _rows(read_features(spark, out)) == want
    fn(frame(spark, [candle("T", 3 * DAY, 8.0)]), 5)
    assert _rows(read_features(spark, out)) == _rows(features(frame(spark, [*final, candle("T", 3 * DAY, 8.0)])))


def test_a_compaction_lost_midway_changes_nothing(spark, monkeypatch):
    parts = [_hours("S", 0, 2, 1.0), _hours("S", 2, 1, 2.0), _hours("S", 3, 1, 4.0)]
    d, fn = _stream(spark, "incr-lost-", parts)
    out, state = f"{d}/out", f"{d}/silver"
    want = _rows(read_features(spark, out))
    real, calls = incremental._write_buckets, []

    def failing(rows, path):
        real(rows, path)
        calls.append(path)
        if len(calls) == fail_at:
            raise RuntimeError("lost")

    for fail_at in (1, 2):
        calls.clear()
        monkeypatch.setattr(incremental, "_write_buckets", failing)
        with pytest.raises(RuntimeError, match="lost"):
            compact_state(spark, out, state)
        monkeypatch.setattr(incremental, "_write_buckets", real)
        assert _rows(read_features(spark, out)) == want
        fn(frame(spark, parts[2]), 2)
    assert compact_state(spark, out, state) == 1
    assert _rows(read_features(spark, out)) == want


def test_bars_count_late_events_and_retries(spark):
    d = tempfile.mkdtemp(prefix="bars-", dir="/tmp")
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    for k, part in enumerate((events.where("event_id % 3 = 0"), events.where("event_id % 3 = 1"), events.where("event_id % 3 = 2"))):
        part.write.mode("append").parquet(f"{d}/landed")
        start_bars(events_stream(spark, f"{d}/landed"), f"{d}/bars", f"{d}/ck").awaitTermination()
    assert _rows(read_bars(spark, f"{d}/bars")) == _rows(bars_from_events(events))


def test_a_bad_body_stops_the_stream(spark):
    d = tempfile.mkdtemp(prefix="bad-", dir="/tmp")
    os.makedirs(f"{d}/landed")
    with open(f"{d}/landed/AAA_1m.json", "w") as fh:
        fh.write('{"code": -1121, "msg": "Invalid symbol."}')
    q = kline_stream(spark, f"{d}/landed").writeStream.format("memory").queryName("bad_body").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="no kline body"):
        q.awaitTermination()


ROW = [1700000000000, "1.0", "2.0", "0.5", "1.5", "3.0", 1700000059999, "4.5", 7, "1.0", "1.5", "0"]


def test_overlapping_polls_are_deduplicated(spark):
    d = tempfile.mkdtemp(prefix="polls-", dir="/tmp")
    os.makedirs(f"{d}/landed/symbol=AAA")
    row2 = list(ROW)
    row2[0], row2[6] = ROW[0] + 60000, ROW[6] + 60000
    with open(f"{d}/landed/symbol=AAA/p1.txt", "w") as fh:
        fh.write(json.dumps([ROW, row2]) + "\n")
    with open(f"{d}/landed/symbol=AAA/p2.txt", "w") as fh:
        fh.write(json.dumps([row2]) + "\n")
    stream = dedup_stream(kline_stream(spark, f"{d}/landed"))
    q = (
        stream.writeStream.format("memory")
        .queryName("dedup_polls")
        .option("checkpointLocation", f"{d}/ck")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    assert spark.sql("select * from dedup_polls").count() == 2


def test_stream_scoring(spark):
    from candleflow.sources.events import bars_from_events

    bars = bars_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet"))
    feats = features(to_silver(bars))
    train, _ = train_test(chrono_split(feats))
    model = fit(train, "lr")
    d = tempfile.mkdtemp(prefix="score-", dir="/tmp")
    feats.write.parquet(f"{d}/features")
    stream = spark.readStream.schema(feats.schema).parquet(f"{d}/features")
    q = start_scoring(stream, model, f"{d}/predictions", f"{d}/ck")
    q.awaitTermination()
    preds = spark.read.parquet(f"{d}/predictions")
    assert preds.count() == feats.count()
    assert preds.columns[:2] == ["id", "symbol"]
    assert preds.where(F.col("predicted_price").isNull()).count() == 0


def test_micro_batches_clean_up_after_themselves(spark):
    import glob

    from candleflow.session import ensure_checkpoint_dir

    base = ensure_checkpoint_dir(spark).replace("file:", "")
    before = set(glob.glob(f"{base}/candleflow-*"))
    d = tempfile.mkdtemp(prefix="incr-clean-", dir="/tmp")
    fn = IncrementalFeatures(f"{d}/out", f"{d}/silver")
    for b in range(4):
        fn(frame(spark, [candle("S", 20 * b + m, 10.0 + m) for m in range(20)]), b)
    assert set(glob.glob(f"{base}/candleflow-*")) == before
    assert read_features(spark, f"{d}/out").count() == 80 - 11
