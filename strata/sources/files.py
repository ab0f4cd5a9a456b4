"""File sources: JSON documents, JSON lines, object listings.

Paths may be local or any Hadoop-compatible object store URI; nothing here
opens a file itself, Spark's readers do, on the executors.
"""

from __future__ import annotations

import fnmatch
import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)

DOC_SCHEMA = T.StructType([T.StructField("path", T.StringType()), T.StructField("doc", T.StringType())])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Some path matches a glob pattern."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(pattern)
    found = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hpath)
    return found is not None and len(found) > 0


def hidden_files(spark: SparkSession, path: str, glob: str = "*.json") -> list[str]:
    """Files below ``path`` that match ``glob`` but that Spark's sources skip,
    because a name on the way starts with ``_`` or ``.``. Names only are listed."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.makeQualified(root).toString().rstrip("/")
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        parts = name[len(base):].strip("/").split("/") if name.startswith(base) else [name.split("/")[-1]]
        # A folder of a partition (``_a=1``) is read, as Spark reads it.
        skipped = any(p.startswith((".", "_")) and "=" not in p for p in parts if p)
        if skipped and fnmatch.fnmatch(parts[-1], glob) and not any(p == "_temporary" for p in parts):
            found.append(name)
    return sorted(found)


def read_json_documents(spark: SparkSession, path: str | Sequence[str], recursive: bool = True,
                        glob: str = "*.json", skip_hidden: bool = False) -> DataFrame:
    """One row per JSON file: ``path`` (full URI) and ``doc`` (its whole text).

    One path, or several that make one scan. A folder is scanned recursively for ``glob`` in one multi-file scan (no
    driver-side loop over files). A missing path gives an empty result with a
    warning. Spark's sources skip names that start with ``_`` or ``.``; if
    such a file would match, the call fails and names it, or with
    ``skip_hidden`` warns. Each document is read whole by one task, which
    suits the bounded bronze files; unbounded inputs should be written and
    read as JSON lines.
    """
    paths = []
    for given in [path] if isinstance(path, str) else path:
        if _exists(spark, given):
            paths.append(given)
        else:
            log.warning("No such input: %s (nothing to read)", given)
    if not paths:
        return spark.createDataFrame([], DOC_SCHEMA)
    hidden = [name for given in paths for name in hidden_files(spark, given, glob)]
    if hidden:
        text = f"{len(hidden)} JSON files have names that the reader skips, such as {hidden[0]}"
        if not skip_hidden:
            raise ValueError(text)
        log.warning("%s", text)
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.text(paths, wholetext=True)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))


def landing_folders(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """(landings, others): the entries of a folder that :func:`strata.sinks.files.write_raw`
    made (``source=<s>``), and all others."""
    if not _exists(spark, path):
        return [], []
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    landed, others = [], []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith("source="):
            landed.append(status.getPath().toString())
        elif name != "_SUCCESS" and not name.startswith("._SUCCESS"):
            others.append(status.getPath().toString())
    return sorted(landed), sorted(others)


def read_landing(spark: SparkSession, folders: list[str]) -> DataFrame:
    """Raw landings (K3) as documents: ``path``, ``doc`` (one record) and
    ``landed_source`` (from the folder). Lines are records, so large files split."""
    lines = (spark.read.option("pathGlobFilter", "part-*").option("recursiveFileLookup", True).text(folders)
             .select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc")))
    return lines.where(F.trim("doc") != "").withColumn("landed_source", landed_source(F.col("path")))


def landed_source(path: Column) -> Column:
    """The source of a raw landing's file, from its folder."""
    return F.url_decode(F.regexp_replace(F.regexp_extract(path, r"/source=([^/]*)/", 1), r"\+", "%2B"))


def stream_documents(spark: SparkSession, path: str, glob: str = "*.json", lines: bool = False,
                     max_files: int | None = None) -> DataFrame:
    """S5/S6 as a file stream: ``path`` and ``doc`` of every file below ``path`` that is new since the
    stream's checkpoint; with ``lines`` every line is a document."""
    reader = (spark.readStream.format("text").option("pathGlobFilter", glob).option("recursiveFileLookup", True)
              .option("wholetext", not lines))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    docs = reader.load(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))
    return docs.where(F.trim("doc") != "") if lines else docs


def read_json_lines(spark: SparkSession, path: str, glob: str = "*.json",
                    recursive: bool = True) -> DataFrame:
    """JSON lines as text: ``path``, ``value`` (one record per line), splittable."""
    reader = spark.read.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.text(path).select(F.col("_metadata.file_path").alias("path"), "value")


def list_objects(spark: SparkSession, prefix: str, glob: str = "*") -> DataFrame:
    """``path``, ``length``, ``modificationTime`` of every object under a prefix.

    The ``content`` column is never selected, so the listing reads no data.
    """
    if not _exists(spark, prefix):
        return spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", glob).load(prefix)
            .select("path", "length", "modificationTime"))


def read_shipping_payload(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """Shipments of landed API payloads ``{"shipments": [...]}``.

    A payload without ``shipments`` contributes no rows (the list defaults
    to empty); one row per shipment, with the payload's path.
    """
    docs = read_json_documents(spark, path, glob=glob)
    v = F.try_parse_json("doc")
    ships = F.coalesce(F.try_variant_get(v, "$.shipments", "array<variant>"), F.array().cast("array<variant>"))
    return docs.select("path", F.explode(ships).alias("shipment"))
