import pytest
from pyspark.sql import functions as F

from strata.operators import contracts as C


def _records(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "idx long, value string")


def test_clickstream_accepted_and_ts_copied(spark):
    df = _records(spark, '{"event_id":"evt-1","event_type":"view","user_id":101,"event_time":"2026-06-11T10:00:00Z"}')
    v = C.validate(df, "clickstream_events", keep=("idx",))
    rows = v.valid.collect()
    assert len(rows) == 1 and v.quarantine.count() == 0
    assert rows[0].ts == "2026-06-11T10:00:00Z" and rows[0].user_id == "101"


def test_server_log_string_becomes_message(spark):
    line = "2026-06-11T10:00:00Z 127.0.0.1 api-gateway GET /home 200 100ms"
    df = _records(spark, line, '"' + line + '"')
    rows = C.validate(df, "server_logs", keep=("idx",)).valid.orderBy("idx").collect()
    assert [r.message for r in rows] == [line, line]


def test_invalid_shipment_strict(spark):
    df = _records(spark, '{"shipment_id":"s-1"}')
    with pytest.raises(ValueError, match="Invalid record at index 0 for shipment_data"):
        C.validate_strict(df, "shipment_data", index_col="idx")


def test_unknown_source():
    with pytest.raises(ValueError, match="Unknown Bronze source schema"):
        C.contract_for("nope")


def test_user_id_truthiness_and_types(spark):
    base = '"event_id":"e","event_type":"t"'
    df = _records(spark, *[f'{{{base},"user_id":{u}}}' for u in ("0", "true", "1.0", '""', "null")],
                  f'{{{base}}}', f'{{{base},"user_id":1,"ts":null}}', "[1]", "not json",
                  f'{{{base},"user_id":1,"amount":"5"}}', f'{{{base},"user_id":12345678901234567890}}')
    v = C.validate(df, "clickstream_events", keep=("idx",))
    valid = {r.idx: r for r in v.valid.collect()}
    bad = {r.idx: r.error for r in v.quarantine.collect()}
    assert sorted(valid) == [0, 1, 6, 10]
    assert valid[6].ts is None                    # explicit null ts is kept
    assert bad[2] == "field 'user_id' must be one of (int, str)"
    assert bad[3] == bad[4] == bad[5] == "missing required fields ['user_id']"
    assert bad[7] == bad[8] == "expected an object"
    assert bad[9] == "field 'amount' must be one of (int, float)"


def test_all_missing_listed(spark):
    df = _records(spark, '{"event_id":""}')
    q = C.validate(df, "clickstream_events").quarantine.select(F.col("error")).first()
    assert q.error == "missing required fields ['event_id', 'event_type', 'user_id']"
