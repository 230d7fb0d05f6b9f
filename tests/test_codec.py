import datetime as dt

from basketry.sources.streams import decode_events, encode_events
from basketry.functions.text import padded_id


def _decode(spark, values):
    return decode_events(spark.createDataFrame([(v,) for v in values], "value string"))


def test_malformed_json_gives_row_of_nulls(spark):
    rows = _decode(spark, ["garbage", None]).collect()
    assert len(rows) == 2
    assert all(all(v is None for v in r) for r in rows)


def test_loose_typing_keeps_text(spark):
    row = _decode(spark, ['{"user_id":5,"category":{"a":1},"extra":"x"}']).collect()[0]
    assert row.user_id == "5"
    assert row.category == '{"a":1}'


def test_bad_timestamp_is_null_not_error(spark):
    row = _decode(spark, ['{"user_id":"U1","timestamp":"bad"}']).collect()[0]
    assert row.timestamp is None and row.user_id == "U1"


def test_iso_with_and_without_fraction(spark):
    rows = _decode(spark, [
        '{"timestamp":"2026-01-02T03:04:05.678901+00:00"}',
        '{"timestamp":"2026-01-02T03:04:05+00:00"}',
    ]).collect()
    assert rows[0].timestamp == dt.datetime(2026, 1, 2, 3, 4, 5, 678901)
    assert rows[1].timestamp == dt.datetime(2026, 1, 2, 3, 4, 5)


def test_encode_keeps_nulls_and_microseconds(spark):
    df = spark.createDataFrame(
        [("U0001", "P0002", None, "view", dt.datetime(2026, 1, 2, 3, 4, 5, 6))],
        "user_id string, product_id string, category string, event_type string, timestamp timestamp",
    )
    value = encode_events(df).collect()[0].value
    assert value == ('{"user_id":"U0001","product_id":"P0002","category":null,"event_type":"view",'
                     '"timestamp":"2026-01-02T03:04:05.000006+00:00"}')
    back = decode_events(encode_events(df)).collect()[0]
    assert back.asDict() == df.collect()[0].asDict()


def test_padded_id_is_never_cut(spark):
    df = spark.createDataFrame([(1,), (12345,), (-3,), (None,)], "n long")
    got = [r.u for r in df.select(padded_id("U", "n").alias("u")).collect()]
    assert got == ["U0001", "U12345", "U-003", None]
