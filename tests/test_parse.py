from pyspark.sql import types as T

from strata.functions import parse as P

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("i", T.IntegerType()),
                       T.StructField("d", T.DoubleType())])


def _parse(spark, values, **kw):
    df = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "n int, value string")
    out = P.parse_json_columns(df, SCHEMA, keep=("n",), **kw).orderBy("n").collect()
    return [tuple(r)[1:] for r in out]


def test_from_json_edge_table(spark):
    rows = _parse(spark, [None, "", "not json", '{"a":"x","i":1', "[1]", "5", "{}", '{"A":"x"}',
                          '{"a":5,"i":"7","d":"2.5"}', '{"a":{"z":1},"i":3.0}', '{"a":"x","i":99999999999}',
                          '{"a":"x","i":1} trailing', '{"a":"x","a":"y","i":2}', '{"a":"ok","i":3,"d":1.5}'])
    nulls = (None, None, None)
    assert [r[:3] for r in rows[:6]] == [nulls] * 6
    assert all(r[3] for r in rows[:6])           # flagged malformed
    assert rows[6] == (None, None, None, False)  # {} parses to all-null, not malformed
    assert rows[7] == (None, None, None, False)  # keys are case-sensitive
    assert rows[8] == ("5", None, None, True)    # quoted numbers not coerced
    assert rows[9][:2] == ('{"z":1}', None)
    assert rows[10] == ("x", None, None, True)   # int overflow: partial result
    assert rows[11] == ("x", 1, None, False)     # trailing text ignored
    assert rows[12] == ("y", 2, None, False)     # last duplicate wins
    assert rows[13] == ("ok", 3, 1.5, False)
    assert len(_parse(spark, ["not json", '{"a":"ok"}'], drop_malformed=True)) == 1


def test_log_regex_edges(spark):
    lines = [
        "2026-06-11T10:00:00Z 127.0.0.1 api-gateway GET /home 200 100ms",
        "2026-06-11T10:00:00Z\t127.0.0.1  api-gateway GET /home 200 100ms",
        " 2026-06-11T10:00:00Z 127.0.0.1 api-gateway GET /home 200 100ms",
        "2026-06-11T10:00:00Z 127.0.0.1 api-gateway GET /home 20000000000 100ms",
        "2026-06-11T10:00:00Z 127.0.0.1 api-gateway GET /home 200 12s",
        None,
        "2026-06-11T10:00:00Z 127.0.0.1 api-gateway GET /home 007 100ms",
    ]
    df = spark.createDataFrame([(n, v) for n, v in enumerate(lines)], "n int, value string")
    good, bad = P.split_log_lines(df, keep=("n",))
    g = {r.n: r for r in good.collect()}
    assert sorted(g) == [0, 1, 3, 6]
    assert g[0].status_code == 200 and g[0].latency_ms == 100 and g[0].service == "api-gateway"
    assert g[3].status_code is None
    assert g[6].status_code == 7
    assert sorted(r.n for r in bad.collect()) == [2, 4, 5]
    assert P.parse_log_lines(df).count() == 4
