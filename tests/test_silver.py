import json
import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import jobs
from strata.functions import flatten as FL
from strata.operators import normalize as N
from tests.conftest import docs


def test_reference_normalize_vector(spark):
    d = docs(spark, json.dumps([{"event_id": "e-1", "event_type": "purchase", "amount": 10.5},
                                {"shipment_id": "s-1", "status": "delivered", "tracking": {"carrier": "UPS"}}]))
    rows = N.normalize(d, "shipping").orderBy("record_index").collect()
    assert rows[0].source_name == "shipping" and rows[0].event_id == "e-1" and rows[0].record_index == 0
    assert rows[1].tracking_carrier == "UPS" and rows[1].record_index == 1


def test_scalars_null_source_and_shipments_object(spark):
    rows = N.normalize(docs(spark, '[{"a":1}, 5, "x"]'), "s").orderBy("record_index").collect()
    assert [r.record_index for r in rows] == [0, 1, 2]
    assert rows[0].a == 1 and rows[0].value is None
    assert rows[1].value is not None and rows[1].a is None and rows[1].source_name == "s"
    kept_null = N.normalize(docs(spark, '[{"a":1,"source_name":null}]'), "s").first()
    assert kept_null.source_name is None
    own = N.normalize(docs(spark, '[{"a":1,"source_name":"mine","record_index":7}]'), "s").first()
    assert own.source_name == "mine" and own.record_index == 7
    shipments_obj = N.normalize(docs(spark, '{"shipments": {"a": 1}}', path="b/x_1.json"), None).collect()
    assert len(shipments_obj) == 1 and shipments_obj[0].shipments_a == 1
    assert shipments_obj[0].source_name == "shipping"
    unwrapped = N.normalize(docs(spark, '{"shipments": [{"a": 1}, {"a": 2}]}', path="b/x_1.json"), None)
    assert sorted(r.a for r in unwrapped.collect()) == [1, 2]


def test_source_from_file_stem(spark):
    rows = N.normalize(docs(spark, '[{"a":1}]', path="bronze/orders/orders_2024.json"), None).collect()
    assert rows[0].source_name == "orders"


def test_flatten_edges(spark):
    df = spark.createDataFrame([('{"a":{},"l":[{"z":1}],"t":{"d":{"e":2}}}',)], "value string")
    wide = FL.flatten_json(df)
    assert wide.columns == ["l", "t_d_e"]
    row = wide.first()
    assert row.t_d_e == 2 and row.l[0].z == 1
    ragged = FL.flatten_ragged(df).first().record
    assert sorted(ragged) == ["l", "t_d_e"]


def test_ragged_and_clash(spark):
    df = spark.createDataFrame([('{"c":{"k":1,"n":{"x":"a"}}}',), ('{"c":5}',), ('{"t_c":1,"t":{"c":2}}',)],
                               "value string")
    rows = [r.record for r in FL.flatten_ragged(df).collect()]
    assert sorted(rows[0]) == ["c_k", "c_n_x"]
    assert sorted(rows[1]) == ["c"]
    assert len(rows[2]) == 1 and str(rows[2]["t_c"]) == "2"  # the later in the document wins


def flat(spark, *records):
    df = spark.createDataFrame([(json.dumps(r),) for r in records], "value string")
    return FL.flatten_json(df), [{k: v.toPython() for k, v in r.record.items()} for r in FL.flatten_ragged(df).collect()]


def test_clashes_follow_the_document_and_null_wins(spark):
    _, maps = flat(spark, {"t": {"c": 2}, "t_c": None}, {"t_c": 1, "t": {"c": 2}}, {"x": {"t": {"c": 2}, "t_c": None}})
    assert maps == [{"t_c": None}, {"t_c": 2}, {"x_t_c": None}]
    wide, _ = flat(spark, {"t_c": "x", "t": {"c": 2}}, {"t_c": "y"}, {"t": {"c": 3}, "t_c": None})
    assert [r.t_c.toPython() if r.t_c is not None else None for r in wide.collect()] == [2, "y", None]


def test_an_object_in_some_records_and_a_scalar_in_others(spark):
    wide, maps = flat(spark, {"c": 1}, {"c": {"d": 2}})
    assert wide.columns == ["c", "c_d"]
    assert [(r.c, r.c_d) for r in wide.collect()] == [(1, None), (None, 2)]
    assert maps == [{"c": 1}, {"c_d": 2}]


def test_key_names_are_left_alone(spark):
    wide, _ = flat(spark, {"AVOIDED": 1, "VOID": 2, "a VOID,": {"OBJECT": [{"VOID": None, "x>VOID": 1}]}, "n": None})
    row = wide.first().asDict()
    assert row["AVOIDED"] == 1 and row["VOID"] == 2 and row["n"] is None
    assert row["a VOID,_OBJECT"][0].asDict() == {"VOID": None, "x>VOID": 1}


def test_any_depth(spark):
    deep = 7
    for _ in range(60):
        deep = {"a": deep}
    wide, maps = flat(spark, deep)
    name = "_".join("a" * 60)
    assert wide.first()[name] == 7 and maps == [{name: 7}]


def test_names_that_differ_in_case(spark, scratch):
    wide, _ = flat(spark, {"a": 1, "A": 2}, {"A_2": 5})
    wide.write.parquet(f"{scratch}/case")
    rows = [r.asDict() for r in spark.read.parquet(f"{scratch}/case").collect()]
    assert sorted((r["A"], r["A_2"], r["a_3"]) for r in rows if r["A"]) == [(2, None, 1)]


def test_numbers_keep_their_digits(spark):
    df = spark.createDataFrame([('{"a":{"b":1.10,"c":12345678901234567890,"d":1e2}}',)], "value string")
    record = FL.flatten_ragged(df).select(F.to_json("record").alias("r")).first().r
    assert json.loads(record, parse_float=str, parse_int=str)["a_c"] == "12345678901234567890"


def test_pretty_printed_documents(spark, scratch):
    import os
    os.makedirs(f"{scratch}/b/deep")
    with open(f"{scratch}/b/orders_1.json", "w") as fh:
        json.dump([{"order_id": 1, "c": {"d": "x"}}, {"order_id": 2}], fh, indent=2)
    with open(f"{scratch}/b/deep/shipping_2.json", "w") as fh:
        json.dump({"shipments": [{"order_id": 1}, {"order_id": 9}]}, fh, indent=2)
    with open(f"{scratch}/b/broken_3.json", "w") as fh:
        fh.write("{broken")
    from strata.sources import files
    assert files.read_json_documents(spark, f"{scratch}/b").count() == 3
    assert files.read_shipping_payload(spark, f"{scratch}/b").count() == 2
    out = jobs.silver_folder_job(spark, f"{scratch}/b", f"{scratch}/s")
    rows = spark.read.parquet(out).collect()
    assert sorted((r.dataset, r.source_name, r.record_index, r.order_id) for r in rows) == [
        ("deep_shipping_2", "shipping", 0, 1), ("deep_shipping_2", "shipping", 1, 9), ("orders_1", "orders", 0, 1),
        ("orders_1", "orders", 1, 2)]
    bad = spark.read.parquet(f"{out}/{jobs.QUARANTINE}").collect()
    assert [(r.dataset, r.doc, r.error) for r in bad] == [("broken_3", "{broken", jobs.NOT_JSON)]


def test_hidden_files_are_named_not_lost(spark, scratch):
    import os

    import pytest

    from strata.sources import files
    os.makedirs(f"{scratch}/h/_tmp")
    for name in ("a.json", "_b.json", "_tmp/c.json", "_SUCCESS"):
        with open(f"{scratch}/h/{name}", "w") as fh:
            fh.write("[]")
    with pytest.raises(ValueError, match="2 JSON files"):
        files.read_json_documents(spark, f"{scratch}/h")
    assert files.read_json_documents(spark, f"{scratch}/h", skip_hidden=True).count() == 1


def test_landing_to_silver(spark, scratch):
    from strata.sinks import files as sinks
    orders = spark.createDataFrame([(i, (f"n{i}",)) for i in range(20)], "order_id int, customer struct<name:string>")
    sinks.write_raw(orders.repartition(3), f"{scratch}/bronze", "web orders", "r1")
    sinks.write_raw(orders.limit(2), f"{scratch}/bronze", "late", "r2")
    with open(f"{scratch}/bronze/extra_1.json", "w") as fh:
        json.dump({"order_id": 99}, fh, indent=2)
    out = jobs.silver_folder_job(spark, f"{scratch}/bronze", f"{scratch}/silver")
    rows = spark.read.parquet(out).collect()
    web = [r for r in rows if r.dataset == "web orders"]
    assert len(web) == 20 and {r.source_name for r in web} == {"web orders"}
    assert {r.customer_name for r in web} == {f"n{i}" for i in range(20)}
    assert sorted({r.record_index for r in web}) == list(range(max(r.record_index for r in web) + 1))
    assert [(r.source_name, r.order_id) for r in rows if r.dataset == "extra_1"] == [("extra", 99)]
    assert sum(r.dataset == "late" for r in rows) == 2


def test_struct_flatten(spark):
    df = spark.createDataFrame([(1, (2, (3, "x")))], "id int, s struct<a:int, b:struct<c:int, d:string>>")
    out = FL.flatten_struct(df)
    assert out.columns == ["id", "s_a", "s_b_c", "s_b_d"]


def test_folder_job_round_trip(spark, scratch):
    bronze = f"{scratch}/bronze"
    import os
    os.makedirs(f"{bronze}/sub", exist_ok=True)
    with open(f"{bronze}/orders.json", "w") as fh:
        json.dump([{"order_id": "o-1", "customer": {"name": "Ada"}}], fh)
    with open(f"{bronze}/sub/shipping_1.json", "w") as fh:
        json.dump({"shipments": [{"order_id": "o-1", "status": "shipped"}]}, fh)
    out = f"{scratch}/silver"
    jobs.silver_folder_job(spark, bronze, out)
    back = spark.read.parquet(out)
    rows = {r.dataset: r for r in back.collect()}
    assert set(rows) == {"orders", "sub_shipping_1"}
    o = rows["orders"]
    assert o.customer_name == "Ada" and o.source_name == "orders" and o.record_index == 0
    assert rows["sub_shipping_1"].source_name == "shipping"


def test_missing_folder_is_empty(spark, scratch):
    from strata.sources import files
    assert files.read_json_documents(spark, f"{scratch}/nope").count() == 0


def test_map_form(spark):
    out = N.normalize_map(docs(spark, '[{"a":{"b":1}}, 7]'), "src").collect()
    recs = sorted(({k: v.toPython() for k, v in r.record.items()} for r in out),
                  key=lambda d: d["record_index"])
    assert recs[0] == {"a_b": 1, "source_name": "src", "record_index": 0}
    assert recs[1] == {"value": 7, "source_name": "src", "record_index": 1}


def test_silver_write_round_trip(spark, scratch):
    from strata.sinks import files as sinks
    df = spark.createDataFrame([("e-1", "clickstream", "clickstream")], "event_id string, source_name string, dataset string")
    sinks.write_silver(df, f"{scratch}/silver")
    back = spark.read.parquet(f"{scratch}/silver").collect()
    assert [(r.event_id, r.source_name, r.dataset) for r in back] == [("e-1", "clickstream", "clickstream")]
    other = spark.createDataFrame([("o-1", "orders", "orders")], "event_id string, source_name string, dataset string")
    sinks.write_silver(other, f"{scratch}/silver")   # another dataset: the first one stays
    assert spark.read.parquet(f"{scratch}/silver").count() == 2


def test_flatten_keys_with_quotes_and_dots(spark):
    from strata.functions import flatten as FL
    doc = json.dumps({"it's": {"x.y": 1}, 'a"b': 2})
    df = spark.createDataFrame([(doc,)], "value string")
    row = FL.flatten_json(df).first().asDict()
    assert row == {'a"b': 2, "it's_x.y": 1}


def test_folder_job_map_form(spark, scratch):
    import os
    bronze = f"{scratch}/bronze_m"
    os.makedirs(bronze)
    with open(f"{bronze}/orders_1.json", "w") as fh:
        json.dump([{"order_id": "o-1", "customer": {"name": "Ada"}}, {"order_id": "o-2", "note": None}], fh)
    jobs.silver_folder_job(spark, bronze, f"{scratch}/silver_m", form="map")
    rows = spark.read.parquet(f"{scratch}/silver_m").collect()
    recs = sorted(({k: v.toPython() for k, v in r.record.items()} for r in rows), key=lambda d: d["record_index"])
    assert recs[0] == {"order_id": "o-1", "customer_name": "Ada", "source_name": "orders", "record_index": 0}
    assert recs[1] == {"order_id": "o-2", "note": None, "source_name": "orders", "record_index": 1}
    assert {r.dataset for r in rows} == {"orders_1"}


def test_value_key_and_scalar_elements(spark):
    rows = N.normalize(docs(spark, '[{"value": 3}, 7]'), "s").orderBy("record_index").collect()
    assert [r.value.toPython() for r in rows] == [3, 7]


def test_schema_is_stored_and_reused(spark, scratch):
    df = spark.createDataFrame([('{"a":{"b":1}}',)], "value string").select(F.parse_json("value").alias("v"))
    first = FL.load_or_infer_schema(df, F.col("v"), f"{scratch}/schema")
    other = spark.createDataFrame([('{"z":1}',)], "value string").select(F.parse_json("value").alias("v"))
    again = FL.load_or_infer_schema(other, F.col("v"), f"{scratch}/schema")  # stored shape wins
    assert first == again and first.simpleString() == "struct<a:struct<b:bigint>>"


def test_folder_job_reuses_stored_schema(spark, scratch):
    import os
    bronze = f"{scratch}/bronze_s"
    os.makedirs(bronze)
    with open(f"{bronze}/orders_1.json", "w") as fh:
        json.dump([{"order_id": "o-1"}], fh)
    jobs.silver_folder_job(spark, bronze, f"{scratch}/silver_s", schema_path=f"{scratch}/shape")
    assert os.path.isdir(f"{scratch}/shape")
    rows = jobs.silver_records(spark, bronze, base_dir=bronze, schema_path=f"{scratch}/shape").collect()
    assert rows[0].order_id == "o-1" and rows[0].source_name == "orders"


def test_nothing_is_lost_beyond_the_parsers_limits(spark):
    """A document the parser cannot take goes to quarantine whole; nothing of it vanishes silently."""
    long_number = '{"a":' + "1" * 1200 + ',"b":2}'
    deep = "[" * 1500 + "]" * 1500
    long_string = '{"a":"' + "x" * 21_000_000 + '","b":1}'
    fine = '{"a":' + "1" * 900 + ',"b":2}'
    two = '{"a":1} {"b":2}'
    inject = ('{"a":1},{"b":2}', '{"a":1}],[{"b":2}', "1,2", "1],[2", '{"v":1}}')
    texts = [long_number, deep, long_string, two, *inject, fine, "[]", '{"a":{"b":{}}}']
    d = spark.createDataFrame([(f"{i}.json", t) for i, t in enumerate(texts)], "path string, doc string")
    bad = {r.path: r.doc for r in N.unparsed_documents(d).collect()}
    assert bad == {f"{i}.json": t for i, t in enumerate(texts[:-3])}
    rows = N.normalize_map(d, "s", keep=("path",)).collect()
    kept = {r.path: {k: str(v) for k, v in r.record.items()} for r in rows}
    assert set(kept) == {f"{len(texts) - 3}.json", f"{len(texts) - 1}.json"}
    assert kept[f"{len(texts) - 3}.json"]["b"] == "2"
    both = N.normalize(d, "s", keep=("path",), schema=T.StructType([T.StructField("b", T.LongType())]), rejected="bad").collect()
    assert len(both) == len(texts) - 1 and sum(r.bad is not None for r in both) == len(texts) - 3


def test_wide_lists_and_deep_objects(spark):
    deep = "1"
    for i in range(200):
        deep = f'{{"k{i % 10}":{deep}}}'
    wide = "{" + ",".join(f'"n{i}":{{"v":{i}.50}}' for i in range(1500)) + "}"
    twice = '{"a":{"x":1,"y":2},"a_x":3,"b":[{"q":1.10}],"a":{"x":4.50,"z":1e2}}'
    d = spark.createDataFrame([(t,) for t in (deep, wide, twice)], "doc string")
    out = [{k: str(v) for k, v in r.record.items()} for r in FL.flatten_ragged(d, "doc").collect()]
    assert list(out[0].values()) == ["1"] and len(next(iter(out[0]))) == 200 * 2 + 199
    assert len(out[1]) == 1500 and out[1]["n7_v"] == "7.50"
    assert out[2] == {"a_x": "3", "a_z": "100.0", "b": '[{"q":1.10}]'}


def test_ids_as_keys_are_refused_before_they_are_collected(spark, monkeypatch):
    monkeypatch.setattr(FL, "MAX_NAMES", 50)
    d = spark.createDataFrame([(json.dumps({f"id{i}": i}),) for i in range(60)], "doc string")
    with pytest.raises(ValueError, match="map form"):
        FL.flatten_json(d, "doc")
    assert FL.flatten_ragged(d, "doc").count() == 60


def put(folder, name, text):
    path = f"{folder}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


SHAPE = T.StructType([T.StructField("id", T.LongType()), T.StructField("c_d", T.StringType())])


def test_stream_job_reads_new_documents_only(spark, scratch):
    base = f"{scratch}/bronze"
    run = lambda: jobs.silver_stream_job(spark, base, f"{scratch}/silver", f"{scratch}/ck", SHAPE)
    put(base, "a/x_1.json", json.dumps([{"id": 1, "c": {"d": "p"}}, {"id": 2}], indent=2))
    put(base, "ships.json", json.dumps({"shipments": [{"id": 3}]}, indent=1))
    put(base, "a/b/broken.json", "{")
    run()
    put(base, "later/y_2.json", '{"id": 4}')
    put(base, "a/.hidden.json", '{"id": 99}')
    run()
    run()
    got = jobs.read_silver(spark, f"{scratch}/silver")
    assert sorted((r.dataset, r.source_name, r.record_index, r.id, r.c_d, r.batch_id) for r in got.collect()) == [
        ("a_x_1", "x", 0, 1, "p", 0), ("a_x_1", "x", 1, 2, None, 0), ("later_y_2", "y", 0, 4, None, 1), ("ships", "shipping", 0, 3, None, 0)]
    bad = jobs.read_quarantine(spark, f"{scratch}/silver").collect()
    assert [(r.dataset, r.doc, r.error, r.batch_id) for r in bad] == [("a_b_broken", "{", jobs.NOT_JSON, 0)]
    # A batch that is delivered again rewrites its own folder.
    names = {n for n in os.listdir(f"{scratch}/silver") if not n.startswith((".", "_"))}
    assert names == {"batch_id=0", "batch_id=1"}


def test_stream_job_over_landed_lines(spark, scratch):
    from strata.sinks import files as sinks
    sinks.write_raw(spark.range(5).select(F.col("id")), f"{scratch}/raw", "my src+1")
    jobs.silver_stream_job(spark, f"{scratch}/raw", f"{scratch}/silver", f"{scratch}/ck", SHAPE, glob="part-*", lines=True)
    rows = jobs.read_silver(spark, f"{scratch}/silver").collect()
    assert sorted(r.id for r in rows) == list(range(5)) and {r.dataset for r in rows} == {"my src+1"}


def files_below(folder):
    return [os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet")]


def test_files_do_not_grow_with_documents_and_filters_skip(spark, scratch):
    for i in range(60):
        put(f"{scratch}/many", f"d{i:02}/x.json", json.dumps([{"id": 1000 * i + k} for k in range(300)]))
    jobs.silver_stream_job(spark, f"{scratch}/many", f"{scratch}/silver", f"{scratch}/ck", SHAPE)
    assert len(files_below(f"{scratch}/silver")) <= 10
    one = jobs.read_silver(spark, f"{scratch}/silver").where(F.col("dataset") == "d07_x")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(dataset,d07_x)" in plan and "PartitionFilters: [isnotnull(state" in plan
    assert one.count() == 300
    import pyarrow.parquet as pq
    groups = [pq.ParquetFile(f).metadata.row_group(g).column(pq.ParquetFile(f).schema_arrow.get_field_index("dataset")).statistics
              for f in files_below(f"{scratch}/silver") for g in range(pq.ParquetFile(f).metadata.num_row_groups)]
    if len(groups) > 1:
        assert sum(s.min <= "d07_x" <= s.max for s in groups) < len(groups)


def test_skewed_silver_write_is_split_at_the_advisory_size(spark, scratch):
    from strata.sinks import files as sinks
    keys = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(60_000).select(F.when(F.col("id") % 10 < 8, "hot").otherwise(F.concat(F.lit("d"), F.col("id") % 7)).alias("dataset"),
                                          F.sha2(F.col("id").cast("string"), 256).alias("text"))
        sinks.write_silver(rows, f"{scratch}/out")
    finally:
        for k in keys:
            spark.conf.unset(k)
    hot = [os.path.getsize(f) for f in files_below(f"{scratch}/out/dataset=hot")]
    cold = files_below(f"{scratch}/out")
    assert len(hot) >= 4 and max(hot) < 2 * (sum(hot) / len(hot)) and len(cold) - len(hot) <= 14


def test_a_task_holds_few_records_at_a_time():
    """Batches of documents hold any number of records; those on their way are bounded in number and in characters."""
    target = pa.schema([("k", pa.string()), ("_at", pa.int64()), ("_text", pa.string()), ("_object", pa.bool_()), ("_whole", pa.string())])
    many = "[" + ",".join(f'{{"a":{i}}}' for i in range(3000)) + "]"
    texts = [many] * 5 + ["[1,", "[]", None] + ['{"a":"' + "x" * 3_000_000 + '"}'] * 6
    batch = pa.RecordBatch.from_pydict({"k": [str(i) for i in range(len(texts))], "_doc": texts})
    made = list(FL.walked_batch(batch, ["k"], (), True, target))
    assert all(b.num_rows <= FL.MADE_ROWS and b.nbytes < 2 * FL.MADE_CHARS for b in made) and len(made) >= 5
    rows = [(r["k"], r["_at"], r["_object"], r["_whole"]) for b in made for r in b.to_pylist()]
    assert rows == [(str(k), i, True, None) for k in range(5) for i in range(3000)] + [("5", None, False, "[1,"), ("7", None, False, None)] + [
        (str(k), 0, True, None) for k in range(8, 14)]


def _made(texts, need, explode=True):
    target = pa.schema([("_at", pa.int64()), ("_text", pa.string()), ("_object", pa.bool_()), ("_whole", pa.string())])
    shapes = FL.Shapes() if need == FL.SHAPES else None
    batch = pa.RecordBatch.from_pydict({"_doc": texts})
    return [r for b in FL.walked_batch(batch, [], ("shipments",), explode, target, need, shapes) for r in b.to_pylist()]


def test_names_and_quarantine_take_few_records():
    """A pass for names and types, or for refused documents, hands on entries of new names and types, or the refused alone."""
    texts = [f'{{"k{i % 3}":{i},"t":{{"c":"text {i}","d":[{i},{i}]}}}}' for i in range(2000)] + ["{", '{"a":"b"}"x', None, '{"a":NaN}']
    shapes = _made(texts, FL.SHAPES)
    assert [r["_whole"] for r in shapes if r["_at"] is None] == texts[-4:] and len(shapes) == 3 + 4
    assert [r["_whole"] for r in _made(texts, FL.REFUSED)] == texts[-4:]
    # What only Spark's parser can judge goes on whole.
    deep = "[" * 500 + "]" * 500
    assert len(_made([f'{{"a":{deep}}}'] * 2, FL.REFUSED)) == 2


def test_found_names_and_types_are_those_of_all_records(spark):
    values = ["1", "-20", "0", "1.50", "10.05", "0.007", "1e5", "1E-400", "12345678901234567890", "0." + "3" * 30, "9" * 45, "true", "null", '""',
              '"a\\"b"', '"x:1"', "[]", "[1,2.5]", '[{"b":1},{"b":"x","c":[2]}]', "{}", '{"b":{"c":1}}', '{"b":7}', '"\u00e9"']
    texts = [f'{{"n{i % 7}":{a}, "m{j}" : {b},"n{i % 7}_b":{b}}}' for i, a in enumerate(values) for j, b in enumerate(values)]
    texts += [f'[{texts[3]},{texts[40]},5]', f'{{"shipments":[{texts[77]}]}}', '{"n1":"cut', '{"a":"b"}"x', "01", '{"q2":01}', '{"q3":1}', "NaN", None]
    texts += ['{"long":"' + "x" * 40_000 + '","only_here":1.25}', '{"d":' + "[" * 300 + '"y"' + "]" * 300 + "}"]
    d = docs(spark, *texts).repartition(1)
    flat = F.col("_flat")
    for explode in (True, False):
        every = FL.flat_records(d, "doc", (), ("shipments",), explode).where("_is_object")
        few = FL.flat_records(d, "doc", (), ("shipments",), explode, FL.SHAPES).where("_is_object")
        assert FL.infer_flat_schema(few, flat) == FL.infer_flat_schema(every, flat)
        refused = [FL.flat_records(d, "doc", (), ("shipments",), explode, need).where("_pos IS NULL").select("_rejected").collect()
                   for need in (FL.RECORDS, FL.REFUSED)]
        assert refused[0] == refused[1] and len(refused[0]) == 6


def test_normalize_finds_names_from_few_records(spark, monkeypatch):
    """The pass for names and types sees entries of each name and type, not every record."""
    rows, infer = [], FL.infer_flat_schema
    monkeypatch.setattr(FL, "infer_flat_schema", lambda df, flat: rows.append(df.count()) or infer(df, flat))
    d = docs(spark, *[f'{{"a":{i},"t":{{"b":"x{i}"}}}}' for i in range(500)]).repartition(1)
    out = N.normalize(d, "s")
    assert rows == [1] and {"a", "t_b"} <= set(out.columns) and out.where("a IS NOT NULL AND t_b IS NOT NULL").count() == 500


def test_stream_job_makes_each_record_once(spark, scratch):
    """Silver ranges are found from a sample of the rows; the documents are not read and walked for it again."""
    os.makedirs(f"{scratch}/in")
    for i in range(3):
        with open(f"{scratch}/in/d{i}.json", "w") as f:
            f.write(json.dumps([{"a": i}, {"a": i + 1}]))
    schema, walked = T.StructType([T.StructField("a", T.LongType())]), spark.sparkContext.accumulator(0)
    flat = FL.flat_records

    def counted(docs, *args, **kw):
        rows = flat(docs, *args, **kw)

        def run(batches):
            for batch in batches:
                walked.add(batch.num_rows)
                yield batch
        # The text of a VARIANT goes through the count.
        plain = rows.withColumn("_flat", F.to_json("_flat"))
        return plain.mapInArrow(run, plain.schema).withColumn("_flat", F.try_parse_json("_flat"))

    FL.flat_records = counted
    try:
        jobs.silver_stream_job(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/ckpt", schema)
    finally:
        FL.flat_records = flat
    assert walked.value == 6 and jobs.read_silver(spark, f"{scratch}/out").count() == 6
