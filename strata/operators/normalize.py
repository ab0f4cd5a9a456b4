"""Bronze documents to silver records.

Input: one row per bronze document, with its JSON text and the file path it
came from. Output: one row per record, flattened, with ``source_name`` and
``record_index`` added unless the record already has them.

The whole operator is narrow: one step from documents to flat records (see
:mod:`strata.functions.flatten`) and a projection. ``record_index`` is the
position inside its own document, so no global ordering (and no single-task
sort) is ever needed. Documents that are not JSON give no record;
:func:`unparsed_documents` returns them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import schemas as S
from strata.functions import flatten as FL

SHIPMENTS = S.SHIPMENTS_KEY
ENVELOPE = S.ENVELOPE_KEY


def file_stem(path: Column) -> Column:
    """File name without its last suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_replace(name, r"\.[^.]*$", "")


def source_from_path(path: Column) -> Column:
    """The file stem up to the first ``_``."""
    return F.substring_index(file_stem(path), "_", 1)


def dataset_from_path(path: Column, base_dir: str) -> Column:
    """Path relative to ``base_dir`` without suffix, ``/`` made ``_``."""
    base = base_dir.rstrip("/") + "/"
    rel = F.when(F.startswith(path, F.lit(base)), F.substr(path, F.lit(len(base) + 1))).otherwise(path)
    return F.regexp_replace(F.regexp_replace(rel, r"\.[^./]*$", ""), "/", "_")


def document_source(doc: Column, path: Column) -> Column:
    """``shipping`` for a document (JSON text) with a ``shipments`` key,
    list or not, else the file stem up to the first ``_``."""
    keys = F.json_object_keys(doc)
    wrapped = F.coalesce(F.array_contains(keys, F.lit(SHIPMENTS)), F.lit(False))
    return F.when(wrapped, F.lit(S.SHIPPING_SOURCE)).otherwise(source_from_path(path))


def _records(docs: DataFrame, source: Column | str | None, doc_col: str, keep: tuple[str, ...],
             unwrap_keys: tuple[str, ...], path_col: str) -> DataFrame:
    """Kept columns, ``_src``, ``_pos``, ``_flat`` and ``_is_object`` per record."""
    text = F.to_json(F.col(doc_col)) if isinstance(docs.schema[doc_col].dataType, T.VariantType) else F.col(doc_col)
    if source is None:
        src = document_source(text, F.col(path_col))
    else:
        src = F.lit(source) if isinstance(source, str) else source
    staged = docs.select(*[F.col(k) for k in keep], src.alias("_src"), text.alias("_doc"))
    return FL.flat_records(staged, "_doc", (*keep, "_src"), unwrap_keys)


def unparsed_documents(docs: DataFrame, doc_col: str = "doc") -> DataFrame:
    """The documents that give no record (not JSON, or beyond the parser's limits), with all their columns."""
    others = tuple(c for c in docs.columns if c != doc_col)
    rows = FL.flat_records(docs, doc_col, others, explode=False, need=FL.REFUSED)
    return rows.where(F.col("_pos").isNull()).withColumnRenamed("_rejected", doc_col).select(*docs.columns)


def _present(name: str) -> Column:
    """The flat record has the key, whatever its value (JSON null included)."""
    return F.col("_is_object") & FL.flat_value(F.col("_flat"), name, "variant").isNotNull()


def normalize(docs: DataFrame, source: Column | str | None = None, doc_col: str = "doc",
              keep: tuple[str, ...] = (), unwrap_keys: tuple[str, ...] = (SHIPMENTS,),
              schema: T.DataType | None = None, path_col: str = "path",
              schema_path: str | None = None, rejected: str | None = None) -> DataFrame:
    """Flat records with ``source_name`` and ``record_index``.

    ``source`` is a constant, a column of ``docs``, or None to derive it per
    document from its content and ``path_col`` (P12). ``source_name`` and
    ``record_index`` are set only where the flat record lacks the key, so a
    value already in the record wins, an explicit null included.
    Non-object elements become ``{"value": x}`` records. Names and types are
    found from all records (one aggregate job) unless ``schema`` is given;
    with ``schema_path`` they are found once and reused from there. With
    ``rejected`` a document that gives no record is a row too, its text in the
    column of that name, so that one pass finds records and quarantine.
    """
    rows = _records(docs, source, doc_col, keep, unwrap_keys, path_col)
    if rejected is None:
        rows = rows.where(F.col("_pos").isNotNull())
    flat, obj = F.col("_flat"), F.col("_is_object")
    if schema is None:
        shapes = FL.flat_records(docs, doc_col, (), unwrap_keys, need=FL.SHAPES).where(obj)
        schema = FL.load_or_infer_flat_schema(shapes, flat, schema_path) if schema_path else FL.infer_flat_schema(shapes, flat)
    pairs = dict(FL.flat_columns(F.when(obj, flat), schema))
    if S.VALUE_KEY not in pairs:
        pairs[S.VALUE_KEY] = F.when(~obj, flat)
    else:
        # objects have a "value" key too: one VARIANT column holds both kinds
        pairs[S.VALUE_KEY] = F.when(obj, FL.flat_value(flat, S.VALUE_KEY, "variant")).otherwise(flat)

    def with_default(name: str, default: Column, dtype: str) -> Column:
        pairs.pop(name, None)
        return F.when(_present(name), FL.flat_value(flat, name, dtype)).otherwise(default)

    src_col = with_default(S.SOURCE_NAME, F.col("_src"), "string")
    idx_col = with_default(S.RECORD_INDEX, F.col("_pos"), "bigint")
    return rows.select(*[F.col(k) for k in keep], *[c.alias(n) for n, c in pairs.items()],
                       src_col.alias(S.SOURCE_NAME), idx_col.alias(S.RECORD_INDEX),
                       *([] if rejected is None else [F.col("_rejected").alias(rejected)]))


def object_records(docs: DataFrame, doc_col: str = "doc", keep: tuple[str, ...] = ()) -> DataFrame:
    """The object records of each document, flat (non-objects dropped)."""
    rows = FL.flat_records(docs, doc_col, keep)
    return rows.where(F.col("_is_object")).select(*[F.col(k) for k in keep], F.col("_flat").alias("record"))


def normalize_map(docs: DataFrame, source: Column | str | None = None, doc_col: str = "doc",
                  keep: tuple[str, ...] = (), unwrap_keys: tuple[str, ...] = (SHIPMENTS,),
                  path_col: str = "path") -> DataFrame:
    """P7-P12 in the map form: ``record`` is a ``map<string, variant>``
    with the flattened keys of that record only, plus ``source_name`` and
    ``record_index`` set where absent (an explicit null is kept)."""
    rows = _records(docs, source, doc_col, keep, unwrap_keys, path_col).where(F.col("_pos").isNotNull())
    record = F.when(F.col("_is_object"), F.try_variant_get("_flat", "$", "map<string,variant>")).otherwise(
        F.create_map(F.lit(S.VALUE_KEY), F.col("_flat")))
    flat = rows.select(*[F.col(k) for k in keep], "_src", "_pos", record.alias("record"))
    m = F.col("record")
    meta = F.create_map(
        F.lit(S.SOURCE_NAME), F.col("_src").cast("variant"),
        F.lit(S.RECORD_INDEX), F.col("_pos").cast("bigint").cast("variant"))
    # Existing keys win (map_concat keeps the last duplicate only under
    # LAST_WIN, so absent keys are added by filtering the metadata first).
    missing_meta = F.map_filter(meta, lambda k, _: ~F.map_contains_key(m, k))
    return flat.select(*[F.col(k) for k in keep], F.map_concat(m, missing_meta).alias("record"))
