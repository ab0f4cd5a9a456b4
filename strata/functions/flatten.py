"""Flatten nested records into one level, keys joined by ``_``.

A record keeps the order of its document: where two paths give the same name
(``{"t_c": 1, "t": {"c": 2}}``) the later one in the document wins, a JSON
null included. Objects are walked to any depth, lists are kept as lists, empty
objects vanish, numbers keep the digits they were written with.

VARIANT sorts object keys, so document order cannot be had from it. The walk
itself is therefore a small per-record helper behind one narrow ``mapInArrow``
step; it turns each document into flat JSON objects, and everything after it
(types, columns, metadata) is Spark expressions over those.

A pass that only looks for names and types, or for refused documents, hands on
no more than it needs: entries of a name and type not seen before, or the
records of which Spark's parser has the last word (see :func:`needed_records`).

Two forms, neither with a shuffle:

1. **Wide** (:func:`flatten_json`): a column per flat name. Names and types are
   given, or found by one distributed aggregate over the flat entries, so a
   name that holds an object in some records and a scalar in others simply
   gives ``c`` and ``c_d``.
2. **Map** (:func:`flatten_ragged`): ``map<string, variant>`` with the names of
   that record only.

What Spark's VARIANT parser does not take (numbers of over 1,000 digits, strings
of over 20 MB, lists nested some 900 deep) is no record, just as broken text is
none: the document is reported whole with a null position, for quarantine.
Should a record fail there for any other reason, it is reported alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from strata.functions.columns import computed_once
from strata.functions.variant import path as variant_path
from strata.schemas import FLATTEN_SEPARATOR

SEP = FLATTEN_SEPARATOR

# --- one record -----------------------------------------------------------------


class _Number(str):
    """A JSON number as it was written."""


# Columns that a wide table may have.
MAX_NAMES = 20_000
# Limits of Spark's JSON parser; beyond them a record would turn into null.
MAX_DIGITS, MAX_STRING = 1_000, 20_000_000
# Records, and characters of them, that a task gathers before it hands them on.
MADE_ROWS, MADE_CHARS = 5_000, 8_000_000
# JSON text of so many characters and brackets at most is well within the parser's limits on names, depth and size.
PLAIN_CHARS, PLAIN_BRACKETS = 30_000, 400
# Numbers of fewer characters keep their type when their digits change: they fit a BIGINT or a DECIMAL.
PLAIN_DIGITS = 18
# Levels of objects that are walked by calls, which is faster; a stack takes the deeper ones.
CALL_LEVELS = 50
# What a pass needs: every record, names and types of the entries, or the refused documents.
RECORDS, SHAPES, REFUSED = "records", "shapes", "refused"


def _refuse(token: str):
    raise ValueError(f"not JSON: {token}")


def _number(token: str) -> _Number:
    if len(token) > MAX_DIGITS:
        raise ValueError("a number beyond the parser's limit")
    return _Number(token)


# One decoder for all documents: ``json.loads`` with arguments makes one per call.
_load = json.JSONDecoder(parse_int=_number, parse_float=_number, parse_constant=_refuse).decode
_quoted = json.encoder.encode_basestring_ascii
_CONSTANTS = {None: "null", True: "true", False: "false"}


def _dump(value) -> str:
    kind = type(value)
    if kind is _Number:
        return str(value)
    if kind is str:
        if len(value) > MAX_STRING:
            raise ValueError("a string beyond the parser's limit")
        return _quoted(value)
    if kind is list:
        return "[" + ",".join([_dump(v) for v in value]) + "]"
    if kind is dict:
        return "{" + ",".join([f"{_quoted(k)}:{_dump(v)}" for k, v in value.items()]) + "}"
    return _CONSTANTS[value]


def _entries_below(record: dict, name: str, out: dict) -> None:
    # A stack, so depth is bounded by the document alone.
    stack = [(name, iter(record.items()))]
    while stack:
        prefix, entries = stack[-1]
        for key, value in entries:
            if type(value) is dict:
                stack.append((f"{prefix}{key}{SEP}", iter(value.items())))
                break
            out[prefix + key] = value
        else:
            stack.pop()


def _entries(record: dict, prefix: str, out: dict, levels: int) -> None:
    for key, value in record.items():
        if type(value) is not dict:
            out[prefix + key] = value
        elif levels:
            _entries(value, f"{prefix}{key}{SEP}", out, levels - 1)
        else:
            _entries_below(value, f"{prefix}{key}{SEP}", out)


def flat_entries(record: dict) -> dict:
    """The flat form of a record; of equal names the last in the document wins."""
    out: dict = {}
    _entries(record, "", out, CALL_LEVELS)
    return out


def _records(text: str, unwrap_keys: Sequence[str], explode: bool) -> list:
    doc = _load(text)
    if not explode:
        return [doc]
    if isinstance(doc, dict):
        for key in unwrap_keys:
            if isinstance(doc.get(key), list):
                return doc[key]
    return doc if isinstance(doc, list) else [doc]


def document_records(text: str | None, unwrap_keys: Sequence[str], explode: bool = True) -> list[tuple[str, bool]] | None:
    """(flat JSON text, is an object) of a document's records, None if it is not JSON or beyond the parser's limits.

    ``{"<key>": [...]}`` for a key of ``unwrap_keys`` gives the list, a list
    stays a list, anything else is a list of one; without ``explode`` the
    document is the one record.
    """
    if text is None:
        return None
    try:
        return [(_dump(flat_entries(r) if isinstance(r, dict) else r), isinstance(r, dict)) for r in _records(text, unwrap_keys, explode)]
    except (ValueError, RecursionError):
        return None


def _plain(text: str) -> bool:
    return len(text) <= PLAIN_CHARS and text.count("[") + text.count("{") <= PLAIN_BRACKETS


_SAME_TYPE = str.maketrans("23456789", "11111111")


def _shape(value) -> str:
    """JSON text of the same type as the value's for Spark's parser: strings are empty, whole numbers and digits
    other than 0 are 1, and a list has its elements' shapes once each."""
    kind = type(value)
    if kind is str:
        return '""'
    if kind is _Number:
        if len(value) >= PLAIN_DIGITS:
            return str(value)
        return "1" if value.isdigit() else value.translate(_SAME_TYPE)
    if kind is list:
        return "[" + ",".join(dict.fromkeys([_shape(v) for v in value])) + "]"
    if kind is dict:
        return "{" + ",".join([f"{_quoted(k)}:{_shape(v)}" for k, v in value.items()]) + "}"
    return _CONSTANTS[value]


class Shapes:
    """Flat names and shapes that a task has met; their size is bounded, what is forgotten is only told again."""

    def __init__(self):
        self.seen: set[str | tuple[str, str]] = set()
        self.chars = 0

    def new(self, flat: dict) -> str | None:
        """The entries of a flat record not met before, as JSON text."""
        found, seen = [], self.seen
        for name, value in flat.items():
            # The most frequent kind has the name alone as its mark.
            mark = name if type(value) is str else (name, _shape(value))
            if mark not in seen:
                found.append((mark, name, _shape(value)))
        if not found:
            return None
        self.chars += sum(2 * len(name) + len(shape) for _, name, shape in found)
        if self.chars > MADE_CHARS:
            self.seen, self.chars = set(), 0
        self.seen.update([mark for mark, _, _ in found])
        return "{" + ",".join([f"{_quoted(name)}:{shape}" for _, name, shape in found]) + "}"


def needed_records(text: str | None, unwrap_keys: Sequence[str], explode: bool, shapes: Shapes | None) -> list[tuple[str, bool]] | None:
    """Like :func:`document_records`, without what Spark's parser need not see.

    A plain record (see ``PLAIN_CHARS``) is sure to parse, so it is left out,
    or with ``shapes`` cut to its entries of a name and type not met before.
    Other records are whole, since the parser decides whether they are records.
    """
    if text is None:
        return None
    sure = _plain(text)
    try:
        flats = [flat_entries(r) if isinstance(r, dict) else r for r in _records(text, unwrap_keys, explode)]
        texts = [None if sure else _dump(flat) for flat in flats]
    except (ValueError, RecursionError):
        return None
    out = []
    for flat, whole in zip(flats, texts):
        obj = isinstance(flat, dict)
        if not sure and not _plain(whole):
            out.append((whole, obj))
        elif shapes is not None and obj:
            new = shapes.new(flat)
            if new is not None:
                out.append((new, True))
    return out


# --- documents to flat records --------------------------------------------------


def walked_batch(batch: pa.RecordBatch, keep: Sequence[str], unwrap_keys: Sequence[str], explode: bool,
                 target: pa.Schema, need: str = RECORDS, shapes: Shapes | None = None) -> Iterator[pa.RecordBatch]:
    """The flat records of a batch of documents, in batches of a bounded size: a document may hold any number of records."""
    rows: list[int] = []
    made: list[tuple] = []
    chars = 0

    def gathered() -> pa.RecordBatch:
        columns = list(batch.select(keep).take(pa.array(rows, pa.int64())).columns) if keep else []
        columns += [pa.array(list(c), t.type) for c, t in zip(zip(*made), list(target)[len(keep):])]
        return pa.RecordBatch.from_arrays(columns, schema=target)

    for i, doc in enumerate(batch.column("_doc")):
        text = doc.as_py()
        records = document_records(text, unwrap_keys, explode) if need == RECORDS else needed_records(text, unwrap_keys, explode, shapes)
        # A rejected document's text goes on once, not beside records.
        for entry in [(None, None, False, text)] if records is None else ((pos, *r, None) for pos, r in enumerate(records)):
            rows.append(i)
            made.append(entry)
            chars += len(entry[1] or entry[3] or "")
            if len(rows) >= MADE_ROWS or chars >= MADE_CHARS:
                yield gathered()
                rows, made, chars = [], [], 0
    if rows:
        yield gathered()


def flat_records(docs: DataFrame, doc_col: str, keep: Sequence[str] = (), unwrap_keys: Sequence[str] = (),
                 explode: bool = True, need: str = RECORDS) -> DataFrame:
    """Kept columns, ``_pos``, ``_flat`` (VARIANT), ``_is_object`` and ``_rejected`` per record.

    A record that is no object has its own value in ``_flat``. A document that
    is not JSON, or beyond the parser's limits, gives one row with a null
    ``_pos`` and its text as ``_rejected``, which is null everywhere else.
    Without ``explode`` the document itself is the one record. A VARIANT
    column is taken as its text. With ``need`` as ``SHAPES`` the rows have the
    same names and types as all records (``_pos`` does not count), with
    ``REFUSED`` the same rows with a null ``_pos``, and few others.
    """
    doc = F.col(doc_col)
    if isinstance(docs.schema[doc_col].dataType, T.VariantType):
        doc = F.to_json(doc)
    keep = list(dict.fromkeys(keep))
    source = docs.select(*[F.col(k) for k in keep], doc.cast("string").alias("_doc"))
    fields = T.StructType([*[source.schema[k] for k in keep], T.StructField("_at", T.LongType()), T.StructField("_text", T.StringType()),
                           T.StructField("_object", T.BooleanType()), T.StructField("_whole", T.StringType())])
    target = to_arrow_schema(fields)
    keys = tuple(unwrap_keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes = Shapes() if need == SHAPES else None
        for batch in batches:
            yield from walked_batch(batch, keep, keys, explode, target, need, shapes)

    walked = source.mapInArrow(run, fields)
    out = computed_once(walked, F.try_parse_json("_text"), "_flat", walked.columns)
    lost = F.col("_text").isNotNull() & F.col("_flat").isNull()
    return out.select(*[F.col(k) for k in keep], F.when(~lost, F.col("_at")).alias("_pos"), "_flat",
                      (F.col("_object") & ~lost).alias("_is_object"), F.when(lost, F.col("_text")).otherwise(F.col("_whole")).alias("_rejected"))


# --- names and types ------------------------------------------------------------

_TYPE_TOKEN = re.compile(r"`(?:[^`]|``)*`|\bOBJECT(?=<)|\bVOID(?=\s*(?:[,>]|$))")


def _parse_variant_type(text: str) -> T.DataType:
    """A type that ``schema_of_variant`` printed; key names stay untouched."""
    ddl = _TYPE_TOKEN.sub(lambda m: {"OBJECT": "STRUCT", "VOID": "STRING"}.get(m[0], m[0]), text)
    return T._parse_datatype_string(ddl)


def infer_variant_schema(df: DataFrame, column: Column) -> T.DataType:
    """The merged shape of all values, from one distributed aggregate.

    ``schema_of_variant_agg`` merges partial schemas map-side, so only one
    small string per partition is shuffled. Conflicting shapes become VARIANT.
    """
    text = df.select(F.schema_of_variant_agg(column).alias("s")).first()["s"]
    return T.StructType([]) if text is None else _parse_variant_type(text)


def infer_flat_schema(rows: DataFrame, flat: Column) -> T.StructType:
    """(name, merged type) of all flat entries, from one distributed aggregate.

    The result is as large as the schema. Types of a name that conflict merge
    to VARIANT; a name that is always null is a string. Records whose keys are
    ids have no such schema: with more than ``MAX_NAMES`` names the call fails
    before they are collected, and the map form is the one to use.
    """
    entries = rows.select(F.explode(F.try_variant_get(flat, "$", "map<string,variant>")).alias("name", "value"))
    found = entries.groupBy("name").agg(F.schema_of_variant_agg("value").alias("type")).limit(MAX_NAMES + 1).collect()
    if len(found) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names: use the map form (flatten_ragged, normalize_map, form='map')")
    return T.StructType([T.StructField(r["name"], _parse_variant_type(r["type"] or "VOID"))
                         for r in sorted(found, key=lambda r: r["name"])])


def _stored(df: DataFrame, path: str) -> T.DataType | None:
    try:
        text = df.sparkSession.read.text(path).first()
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return None if text is None else T._parse_datatype_json_string(text["value"])


def _store(df: DataFrame, schema: T.DataType, path: str) -> T.DataType:
    df.sparkSession.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return schema


def load_or_infer_schema(df: DataFrame, column: Column, path: str) -> T.DataType:
    """The shape stored at ``path`` (one line of schema JSON, written with
    Spark so any shared file system works), else inferred from ``df`` and
    stored there. Later batch runs skip inference; streams can pass it on."""
    return _stored(df, path) or _store(df, infer_variant_schema(df, column), path)


def load_or_infer_flat_schema(rows: DataFrame, flat: Column, path: str) -> T.StructType:
    """:func:`infer_flat_schema`, stored and reused like :func:`load_or_infer_schema`."""
    return _stored(rows, path) or _store(rows, infer_flat_schema(rows, flat), path)


def leaf_paths(dtype: T.DataType, prefix: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    """(path, type) of every non-object leaf, in field order; empty objects vanish."""
    if isinstance(dtype, T.StructType):
        out = []
        for f in dtype.fields:
            out.extend(leaf_paths(f.dataType, prefix + (f.name,)))
        return out
    return [(prefix, dtype)]


def flat_names(schema: T.DataType) -> list[tuple[str, T.DataType]]:
    """(flat name, type) of a shape; a name that two paths give is VARIANT where their types differ."""
    out: dict[str, T.DataType] = {}
    for path, dtype in leaf_paths(schema):
        name = SEP.join(path)
        out[name] = dtype if out.get(name, dtype) == dtype else T.VariantType()
    return list(out.items())


def column_names(names: Sequence[str]) -> list[str]:
    """Column names for flat names: one that differs from an earlier name in
    case only gets a number, since column names ignore case."""
    out: list[str] = []
    taken: set[str] = set()
    for name in names:
        new, n = name, 1
        while new.lower() in taken or (n > 1 and new in names):
            n += 1
            new = f"{name}{SEP}{n}"
        taken.add(new.lower())
        out.append(new)
    return out


def type_ddl(dtype: T.DataType) -> str:
    """A type as DDL with every key name quoted."""
    if isinstance(dtype, T.StructType):
        fields = (f"`{f.name.replace('`', '``')}`: {type_ddl(f.dataType)}" for f in dtype.fields)
        return f"STRUCT<{', '.join(fields)}>"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{type_ddl(dtype.elementType)}>"
    return dtype.simpleString()


def flat_value(flat: Column, name: str, dtype: str) -> Column:
    """The value of one flat name, of the given type."""
    if "'" in name and '"' in name:  # no path can hold both quotes
        entry = F.element_at(F.try_variant_get(flat, "$", "map<string,variant>"), F.lit(name))
        return F.try_variant_get(entry, "$", dtype)
    return F.try_variant_get(flat, variant_path(name), dtype)


def flat_columns(flat: Column, schema: T.DataType) -> list[tuple[str, Column]]:
    """(column name, value) of every flat name of a shape."""
    pairs = flat_names(schema)
    out = []
    for new, (name, dtype) in zip(column_names([n for n, _ in pairs]), pairs):
        value = flat_value(flat, name, type_ddl(dtype))
        # A JSON null is a null of the column, whatever the column's type.
        out.append((new, F.when(~F.is_variant_null(value), value) if isinstance(dtype, T.VariantType) else value))
    return out


# --- operators ------------------------------------------------------------------


def flatten_struct(df: DataFrame, column: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Wide flatten of struct columns (``column``, or every column when None).

    Of two leaves with one name the later wins; where the types agree, the
    earlier fills its nulls (a struct cannot tell absent from null).
    """
    schema = df.schema if column is None else T.StructType([df.schema[column]])
    found: dict[str, tuple[Column, T.DataType]] = {}
    for path, dtype in leaf_paths(schema):
        inner = path[1:] if column is not None else path
        name = SEP.join(inner) if inner else path[0]
        value = F.col(".".join(f"`{p}`" for p in path))
        if name in found and found[name][1] == dtype:
            value = F.coalesce(value, found[name][0])
        found[name] = (value, dtype)
    return df.select(*[F.col(k) for k in keep], *[c.alias(n) for n, (c, _) in found.items()])


def flatten_json(df: DataFrame, column: str = "value", keep: tuple[str, ...] = (),
                 schema: T.DataType | None = None) -> DataFrame:
    """JSON text (or VARIANT) flattened wide: a column per flat name.

    Without ``schema`` (flat, or nested with the same flat names) names and
    types are found from all rows first, which takes one job over the input; a
    stream must pass it. Records that are no object, or not JSON, have nulls.
    """
    rows = flat_records(df, column, keep, explode=False)
    flat = F.when(F.col("_is_object"), F.col("_flat"))
    if schema is None:
        schema = infer_flat_schema(flat_records(df, column, explode=False, need=SHAPES), flat)
    return rows.select(*[F.col(k) for k in keep], *[c.alias(n) for n, c in flat_columns(flat, schema)])


def flatten_ragged(df: DataFrame, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Flatten to one ``map<string, variant>`` column ``record`` with the
    names of that record; null where the record is no object."""
    rows = flat_records(df, column, keep, explode=False)
    record = F.when(F.col("_is_object"), F.try_variant_get("_flat", "$", "map<string,variant>"))
    return rows.select(*[F.col(k) for k in keep], record.alias("record"))
