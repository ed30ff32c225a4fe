import datetime as dt
import json
import os
import tempfile

import pytest

from candleflow.operators.clean import to_silver
from candleflow.sources.klines import klines_frame, parse_klines, read_klines, rejected_bodies, rejected_klines, split_klines

ROW1 = [1700000000000, "37000.10", "37010.00", "36990.50", "37005.25", "12.5", 1700000059999, "462565.6", 321, "6.25", "231282.8", "0"]
ROW2 = [1700000060000, "37005.25", "37020.00", "37000.00", "37015.00", "8.0", 1700000119999, "296100.0", 200, "4.0", "148050.0", "0"]


def test_kline_json_file(spark):
    d = tempfile.mkdtemp(prefix="klines-", dir="/tmp")
    with open(os.path.join(d, "BTCUSDT_1m.json"), "w") as fh:
        json.dump([ROW1, ROW2], fh)
    df = read_klines(spark, d)
    rows = df.orderBy("open_time").collect()
    assert len(rows) == 2
    r = rows[0]
    assert r.symbol == "BTCUSDT"
    assert r.open == 37000.10 and r.close == 37005.25 and r.number_of_trades == 321
    assert r.open_time == dt.datetime(2023, 11, 14, 22, 13, 20)
    ms = df.selectExpr("unix_millis(open_time) as a", "unix_millis(close_time) as b").orderBy("a").collect()
    assert (ms[0].a, ms[0].b) == (1700000000000, 1700000059999)
    assert dict(df.dtypes)["number_of_trades"] == "bigint"


def test_bad_string_becomes_null_and_is_dropped_at_silver(spark):
    bad = list(ROW2)
    bad[1] = "abc"
    df = klines_frame(spark, [ROW1, bad], "BTCUSDT")
    rows = df.orderBy("open_time").collect()
    assert rows[1].open is None
    assert to_silver(df).count() == 1


def test_utc_conversions_ignore_the_session_zone(spark):
    from pyspark.sql import functions as F

    from candleflow.functions.columns import utc_instant, utc_wallclock

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.sql(
            "select timestamp_ntz'2024-03-10 02:30:00.123456' as t "
            "union all select timestamp_ntz'1969-12-31 23:59:59.5'"
        )
        out = df.select(
            "t", F.unix_micros(utc_instant("t")).alias("us"), utc_wallclock(utc_instant("t")).alias("back")
        ).collect()
        assert [r.us for r in out] == [1710037800123456, -500000]
        assert all(r.back == r.t for r in out)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def _land(tmp_path, name, body):
    path = tmp_path / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(body)


KLINE = '[[1700000000000,"1","2","0.5","1.5","3",1700000059999,"4.5",7,"1","1.5","0"]]'


def test_symbols_of_file_names_do_not_collide(spark, tmp_path):
    _land(tmp_path, "BTC-USDT_1m.json", KLINE)
    _land(tmp_path, "BTC-EUR_1m.json", KLINE)
    assert {r.symbol for r in read_klines(spark, str(tmp_path)).collect()} == {"BTC-USDT", "BTC-EUR"}
    _land(tmp_path, "x.txt", KLINE)
    with pytest.raises(Exception, match="no symbol"):
        read_klines(spark, str(tmp_path)).collect()


def test_number_like_symbol_folders_stay_text(spark, tmp_path):
    for s in ("007", "7"):
        _land(tmp_path, f"symbol={s}/a.txt", KLINE + "\n")
    assert {r.symbol for r in read_klines(spark, str(tmp_path)).collect()} == {"007", "7"}


def test_bad_bodies_raise_or_are_listed(spark, tmp_path):
    _land(tmp_path, "symbol=A/a.txt", KLINE + "\n" + '{"msg": "Invalid symbol."}' + "\n\nnot json\n")
    with pytest.raises(Exception, match="no kline body"):
        read_klines(spark, str(tmp_path)).collect()
    assert read_klines(spark, str(tmp_path), on_bad="skip").count() == 1
    rejected = rejected_bodies(spark.read.text(str(tmp_path)))
    assert sorted(r.value for r in rejected.collect()) == ["not json", '{"msg": "Invalid symbol."}']


def test_bad_rows_are_set_apart_and_good_ones_stay(spark, tmp_path):
    good = [1700000000000, "1.0", "2.0", "0.5", "1.5", "3.0", 1700000059999, "4.5", 7, "1.0", "1.5", "0"]

    def but(i, v):
        return [v if k == i else x for k, x in enumerate(good)]

    body = [good, good[:11], but(0, "soon"), but(4, "x"), but(8, "1.5"), but(0, 10**17), [], but(11, None), good + ["more"], but(6, None)]
    texts = [json.dumps(body), "[]", " ", '{"msg": "no"}', json.dumps([good, None])]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    kept, bad = split_klines(df, "S")
    reasons = [(r.place, r.reason) for r in bad.orderBy("place").collect()]
    want = [(None, "body is no array of arrays"), (1, "row has fewer than 12 fields"), (1, "row is no array"), (2, "bad time: open_time"), (3, "bad number: close"),
            (4, "bad number: number_of_trades"), (5, "bad time: open_time"), (6, "row has fewer than 12 fields"), (9, "bad time: close_time")]
    assert sorted(reasons, key=str) == sorted(want, key=str)
    assert kept.count() == 4 and kept.where("close = 1.5").count() == 4
    assert sorted(map(str, bad.drop("file").collect())) == sorted(map(str, rejected_klines(df, "S").drop("file").collect()))
    assert sorted(map(str, kept.collect())) == sorted(map(str, parse_klines(df, "S", on_bad="quarantine").collect()))
    assert bad.where("reason like 'bad number: close'").first().raw == json.dumps([str(x) for x in but(4, "x")], separators=(",", ":"))
    # "skip" keeps rows whose fields are bad, for the null policy of silver
    assert parse_klines(df, "S", on_bad="skip").count() == 4 + 5
    for t in (json.dumps([good, good[:11]]), texts[3]):
        with pytest.raises(Exception, match="no kline body"):
            parse_klines(spark.createDataFrame([(t,)], "value string"), "S").count()


def test_rejected_rows_name_their_file(spark, tmp_path):
    (tmp_path / "symbol=007").mkdir()
    (tmp_path / "symbol=007" / "p1.txt").write_text('[["1"]]\n')
    from candleflow.sources.klines import landed_texts

    row = rejected_klines(*landed_texts(spark, str(tmp_path))).first()
    assert (row.symbol, row.place, row.reason) == ("007", 0, "row has fewer than 12 fields") and row.file.endswith("p1.txt")
