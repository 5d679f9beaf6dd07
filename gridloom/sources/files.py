"""Reading registries, record files, page caches and local text; writing the published tables."""

from __future__ import annotations

import json
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridloom.functions import fixed as X
from gridloom.sources.json_arrays import read_json_array, write_csv_document, write_json_array


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name in the store that the driver and all executors share, ``spark.checkpoint.dir``; only on one machine is one made where it is unset."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="spark-checkpoint-")
    return f"{folder}/files-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def artifact_path(spark: SparkSession, folder: str, name: str) -> str:
    """``folder/data/name``, or ``folder/name`` where only that is there."""
    nested = f"{folder}/data/{name}"
    return nested if path_exists(spark, nested) else f"{folder}/{name}"


def read_registry(spark: SparkSession, path: str, include_optional: bool = False, only: list[str] | None = None) -> DataFrame:
    """Enabled sources of a registry file; optional ones are off unless they say otherwise and are asked for."""
    listed = T.ArrayType(X.SOURCE_SCHEMA)
    schema = T.StructType([T.StructField("sources", listed), T.StructField("optional_sources", listed)])
    doc = spark.read.schema(schema).json(path, multiLine=True)

    def part(name: str, default: bool) -> DataFrame:
        rows = doc.select(F.explode(name).alias("s")).select("s.*")
        return rows.where(F.coalesce("enabled", F.lit(default)))

    found = part("sources", True)
    if include_optional:
        found = found.unionByName(part("optional_sources", False))
    return found.where(F.col("id").isin(*only)) if only else found


def read_records(spark: SparkSession, path: str, schema: T.StructType = X.ENDPOINT_SCHEMA) -> DataFrame:
    """Records of a JSON file that is a list or holds one under ``records``; a missing file has none.

    A list is read by as many tasks as it has splits; a file that wraps one by a single task.
    """
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    if _first_character(spark, path) == "[":
        return read_json_array(spark, path, schema)
    wrapped = T.StructType([*schema.fields, T.StructField("records", T.ArrayType(schema))])
    rows = spark.read.schema(wrapped).json(path, multiLine=True)
    plain = rows.where(F.col("records").isNull() & F.coalesce(*[F.col(f).cast("string") for f in schema.names]).isNotNull()).select(*schema.names)
    return plain.unionByName(rows.select(F.explode("records").alias("r")).where("r is not null").select("r.*"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Fetched pages (url, status, content_type, body) from Parquet, or from JSON whose bodies are Latin-1 text."""
    if not path.endswith(".json"):
        return spark.read.schema(X.PAGE_SCHEMA).parquet(path)
    text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "body" else f for f in X.PAGE_SCHEMA])
    return spark.read.schema(text).json(path).withColumn("body", F.encode("body", "ISO-8859-1"))


def read_local_texts(spark: SparkSession, path: str) -> DataFrame:
    """Local text files, one row each: path, text."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    return rows.withColumn("path", F.regexp_replace("path", r"\Afile:/+", "/"))


def _hadoop(spark: SparkSession, path: str):
    """(path object, its file system)."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none where there is no such folder."""
    if not path_exists(spark, path):
        return []
    hadoop, system = _hadoop(spark, path)
    names = [status.getPath().getName() for status in system.listStatus(hadoop)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def _first_character(spark: SparkSession, path: str) -> str:
    """The first character that is not white space of a file, or of the first file of a folder that has one; empty without any."""
    hadoop, system = _hadoop(spark, path)
    if system.getFileStatus(hadoop).isDirectory():
        return next((c for name in _children(spark, path) if (c := _first_character(spark, f"{path}/{name}"))), "")
    stream = system.open(hadoop)
    try:
        while (byte := stream.read()) >= 0:
            if not chr(byte).isspace():
                return chr(byte)
    finally:
        stream.close()
    return ""


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, in whatever store it lies."""
    hadoop, system = _hadoop(spark, path)
    system.delete(hadoop, True)


MANIFEST = "current.json"


def manifest(spark: SparkSession, folder: str) -> dict:
    """What the current version of a published folder is: ``version`` and ``tables``; both empty before the first."""
    if not path_exists(spark, f"{folder}/{MANIFEST}"):
        return {"version": "", "tables": []}
    return json.loads(spark.read.text(f"{folder}/{MANIFEST}", wholetext=True).first()[0])


def swap_manifest(spark: SparkSession, folder: str, content: dict) -> None:
    """Put a manifest in the place of the one before in one step: readers see either, and never a part."""
    jvm, made = spark.sparkContext._jvm, f"{folder}/.{MANIFEST}-{uuid.uuid4().hex}"
    new, system = _hadoop(spark, made)
    out = system.create(new, True)
    out.write(bytearray(json.dumps(content).encode()))
    out.close()
    overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
    overwrite[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(new.makeQualified(system.getUri(), system.getWorkingDirectory()), _hadoop(spark, f"{folder}/{MANIFEST}")[0].makeQualified(system.getUri(), system.getWorkingDirectory()), overwrite)


def publish(spark: SparkSession, folder: str, tables: dict[str, tuple[DataFrame, tuple[str, ...]]], keep: int = 2) -> str:
    """Publish ``tables`` (name: rows and fields) as one version of ``folder`` and return its name.

    Every table is written as Parquet for jobs, and in the same order as one JSON array and one CSV document, each in parts that are put
    together by name. Nothing of the current version is touched: all tables of the new one are there before the manifest names it,
    and a job that is killed before leaves the old version whole. Of the versions before, the last ``keep`` - 1 that are complete stay for readers.
    """
    version = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    base = f"{folder}/versions/{version}"
    before = manifest(spark, folder)
    for name, (rows, fields) in tables.items():
        rows.select(*fields).write.parquet(f"{base}/{name}.parquet")
        stored = spark.read.parquet(f"{base}/{name}.parquet")
        write_json_array(stored, f"{base}/{name}.json", fields)
        write_csv_document(stored, f"{base}/{name}.csv", fields)
    kept = [*before.get("kept", []), *filter(None, [before["version"]])][-(keep - 1) :] if keep > 1 else []
    swap_manifest(spark, folder, {"version": version, "tables": sorted(tables), "kept": kept})
    for name in _children(spark, f"{folder}/versions"):
        if name < version and name not in kept:
            delete(spark, f"{folder}/versions/{name}")
    return version


def published_path(spark: SparkSession, folder: str, name: str, form: str = "parquet") -> str:
    """Where a table of the current version lies, as ``parquet``, ``json`` or ``csv``."""
    if not (version := manifest(spark, folder)["version"]):
        raise FileNotFoundError(f"nothing is published in {folder}")
    return f"{folder}/versions/{version}/{name}.{form}"


def read_published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the current version."""
    return spark.read.parquet(published_path(spark, folder, name))
