"""Raw-record contract checks (V1-V7), compiled to column expressions.

A contract (``strata.schemas.CONTRACTS``) becomes one projection over a
VARIANT column: the type tag from ``schema_of_variant`` replaces the
dynamic ``isinstance`` tests of a record-at-a-time validator, so the check
is a narrow, codegen'd stage that runs on batch and streaming input alike.

Python-type parity through VARIANT tags:

* ``str``   : STRING
* ``int``   : BIGINT / INT / SMALLINT / TINYINT, BOOLEAN (a bool is an int),
  and DECIMAL(p,0) with p >= 19 (integers beyond the long range)
* ``float`` : DOUBLE / FLOAT and every other DECIMAL; ``1.0`` parses as
  DECIMAL(1,0), so it is a float and not an int, as in Python

Known limit: a JSON number such as ``12345678901234567890.0`` (scale 0 after
parsing, 19+ digits) counts as an int here and as a float in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.columns import computed_once
from strata.functions.variant import is_object as variant_is_object
from strata.functions.variant import path as variant_path
from strata import schemas as S
from strata.schemas import CONTRACTS

_INT_TAGS = ("BIGINT", "INT", "SMALLINT", "TINYINT", "BOOLEAN")
_FLOAT_TAGS = ("DOUBLE", "FLOAT")


def _field(v: Column, name: str) -> Column:
    """The field as VARIANT: SQL NULL when absent, variant null when JSON null."""
    return F.try_variant_get(v, variant_path(name), "variant")


def _tag(v: Column) -> Column:
    return F.schema_of_variant(v)


def _is_type(tag: Column, type_name: str) -> Column:
    big_int_decimal = tag.rlike(r"^DECIMAL\((19|[2-9][0-9]|[1-9][0-9]{2,}),0\)$")
    if type_name == "str":
        return tag == F.lit("STRING")
    if type_name == "int":
        return tag.isin(*_INT_TAGS) | big_int_decimal
    if type_name == "float":
        return tag.isin(*_FLOAT_TAGS) | (tag.startswith("DECIMAL") & ~big_int_decimal)
    raise ValueError(f"unknown contract type: {type_name}")


def _type_message(name: str, spec) -> str:
    if isinstance(spec, tuple):
        return S.MSG_TYPES.format(name=name, types=", ".join(spec))
    return S.MSG_TYPE.format(name=name, type=spec)


def _canonical(value: Column, spec) -> Column:
    """Typed value of a declared field (after it passed the check)."""
    kinds = set(spec) if isinstance(spec, tuple) else {spec}
    if "str" in kinds:
        return value.cast("string")
    if "float" in kinds:
        return F.try_variant_get(value, "$", "double")
    return F.try_variant_get(value, "$", "bigint")


@dataclass
class Validated:
    valid: DataFrame
    quarantine: DataFrame


def contract_for(source: str) -> dict:
    """V1: the contract of a known source; an unknown name raises."""
    if source not in CONTRACTS:
        raise ValueError(S.MSG_UNKNOWN_SOURCE.format(source=source))
    return CONTRACTS[source]


def to_variant(df: DataFrame, column: str, source: str) -> Column:
    """The record as VARIANT; V2 turns a bare log string into {"message": s}."""
    dtype = df.schema[column].dataType
    raw = F.col(column)
    if isinstance(dtype, T.VariantType):
        v = raw
    else:
        v = F.try_parse_json(raw.cast("string"))
    if source != "server_logs":
        return v
    as_message = F.parse_json(F.to_json(F.struct(
        (v.cast("string") if isinstance(dtype, T.VariantType) else
         F.when(_tag(v) == F.lit("STRING"), v.cast("string")).otherwise(raw.cast("string"))).alias("message"))))
    if isinstance(dtype, T.VariantType):
        return F.when(_tag(v) == F.lit("STRING"), as_message).otherwise(v)
    # Text input: a line that is no JSON object (free text, a number, a word that JSON knows) is a bare log message.
    return F.when(~variant_is_object(v) & raw.isNotNull(), as_message).otherwise(v)


def checked_records(df: DataFrame, source: str, column: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """V2-V6 as columns: the kept columns, the record as VARIANT, ``errors``
    (every failed check in check order) and the declared fields (V4 applied
    to ``ts``); :func:`split_checked` turns it into valid rows and quarantine."""
    contract = contract_for(source)
    v = to_variant(df, column, source)
    base = computed_once(df, v, "record", keep)
    rec = F.col("record")
    is_object = variant_is_object(rec)

    fields = {name: _field(rec, name) for name in
              list(contract["required"]) + [n for n in contract["types"] if n not in contract["required"]]}
    if source == "clickstream_events":
        # V4: copy event_time to ts only when the key ts is absent.
        ts = _field(rec, "ts")
        fields["ts"] = F.when(ts.isNull(), _field(rec, "event_time")).otherwise(ts)

    def present(name: str) -> Column:
        return fields[name].isNotNull() & ~F.is_variant_null(fields[name])

    missing_names = F.filter(
        F.array(*[F.when(~present(n) | (_tag(fields[n]) == "STRING") & (fields[n].cast("string") == ""),
                         F.lit(n)) for n in contract["required"]]),
        lambda x: x.isNotNull())
    head, tail = S.MSG_MISSING.split("{names}")
    missing_msg = F.when(F.size(missing_names) > 0, F.concat(
        F.lit(head + "'"), F.array_join(missing_names, "', '"), F.lit("'" + tail)))

    type_msgs = []
    for name, spec in contract["types"].items():
        kinds = spec if isinstance(spec, tuple) else (spec,)
        tag = _tag(fields[name])
        ok = None
        for k in kinds:
            ok = _is_type(tag, k) if ok is None else ok | _is_type(tag, k)
        type_msgs.append(F.when(present(name) & ~ok, F.lit(_type_message(name, spec))))

    errors = F.when(~is_object, F.array(F.lit(S.MSG_NOT_OBJECT))).otherwise(
        F.filter(F.array(missing_msg, *type_msgs), lambda x: x.isNotNull()))
    return base.select(*[F.col(k) for k in keep], rec, errors.alias("errors"),
                       *[c.alias(f"_f_{n}") for n, c in fields.items()])


def validate(df: DataFrame, source: str, column: str = "value",
             keep: tuple[str, ...] = ()) -> Validated:
    """V2-V7: split records into valid rows and a quarantine with reasons.

    ``valid`` holds the kept columns, the record as VARIANT (``record``) and
    one typed column per declared field (V4 applied to ``ts``).
    ``quarantine`` holds the kept columns, the record as JSON text,
    ``errors`` (every failed check in check order) and ``error`` (the first,
    which is the message a record-at-a-time validator would stop on).
    """
    return split_checked(checked_records(df, source, column, keep), source, keep)


def split_checked(checked: DataFrame, source: str, keep: tuple[str, ...] = ()) -> Validated:
    """Valid rows and quarantine from one checked frame (see :func:`validate`);
    persist ``checked`` first when both outputs are written."""
    contract = contract_for(source)
    ok_rows = checked.where(F.size("errors") == 0)
    valid = ok_rows.select(
        *[F.col(k) for k in keep], "record",
        *[_canonical(F.col(f"_f_{n}"), spec).alias(n) for n, spec in contract["types"].items()])
    bad = checked.where(F.size("errors") > 0).select(
        *[F.col(k) for k in keep], F.to_json("record").alias("record"), "errors",
        F.element_at("errors", 1).alias("error"))
    return Validated(valid=valid, quarantine=bad)


def validate_strict(df: DataFrame, source: str, index_col: str, column: str = "value") -> DataFrame:
    """V7 strict mode: raise on the lowest-index bad record, else the valid rows.

    The lowest bad index is found with one aggregate (no sort, nothing but
    one row reaches the driver).
    """
    checked = validate(df, source, column, keep=(index_col,))
    first_bad = checked.quarantine.agg(
        F.min_by(F.struct(index_col, "error"), F.col(index_col)).alias("first")).first()["first"]
    if first_bad is not None:
        raise ValueError(S.MSG_INVALID.format(index=first_bad[index_col], source=source, error=first_bad["error"]))
    return checked.valid
