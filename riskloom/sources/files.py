"""CSV and parquet sources and sinks (O-02 .. O-05).

Reads declare their schema, so there is no inference job.  Columns are
bound by the names in the file's header, in whatever order they stand; a
missing column is an error, and so is a further file whose header differs
from the first one's.  ``read_checked_csv`` keeps rows that do not fit the
types apart instead of ending the job.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom import schemas
from riskloom.operators.features import to_vector


#: Column that holds a row as it stands in the file where it does not fit.
BAD = "_bad_row"


def csv_header(spark: SparkSession, path: str, multi_line: bool = False) -> list[str]:
    """Column names of a CSV file or folder: its first line, no pass over the data."""
    return spark.read.option("header", True).option("multiLine", multi_line).csv(path).columns


def _in_file_order(names: list[str], schema: T.StructType) -> T.StructType:
    """The schema as the file has it; columns that the schema does not name are text."""
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"the CSV header {names} lacks {missing}")
    return T.StructType([T.StructField(n, schema[n].dataType if n in schema.names else T.StringType(), True) for n in names])


def _scan(spark: SparkSession, path: str, schema: T.StructType, header: bool, multi_line: bool, mode: str):
    r = spark.read.option("header", header).option("mode", mode).option("multiLine", multi_line)
    # Without this Spark would take names from the schema whatever the header says.
    return r.schema(schema).option("enforceSchema", not header)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True,
             mode: str = "FAILFAST", multi_line: bool = False) -> DataFrame:
    """O-02/O-03: CSV scan with an explicit schema, bound by name (``FAILFAST`` on bad rows).

    ``multi_line`` reads quoted line ends; such files cannot be split, so a
    table should be many files then.  Without a header columns stand in the
    schema's order.
    """
    order = _in_file_order(csv_header(spark, path, multi_line), schema) if header else schema
    return _scan(spark, path, order, header, multi_line, mode).csv(path).select(*[F.col(f"`{n}`") for n in schema.names])


def read_checked_csv(spark: SparkSession, path: str, schema: T.StructType, parsed_path: str,
                     multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """O-02: (rows that fit the schema, rows that do not).

    The files are parsed once, into parquet below ``parsed_path`` that is
    partitioned by whether a row fits; nothing is dropped and the job goes
    on.  A row that does not fit comes as (file, row as it stands, read_as:
    what could be read of it).
    """
    order = _in_file_order(csv_header(spark, path, multi_line), schema)
    full = T.StructType([*order.fields, T.StructField(BAD, T.StringType(), True)])
    rows = _scan(spark, path, full, True, multi_line, "PERMISSIVE").option("columnNameOfCorruptRecord", BAD).csv(path)
    read_as = F.struct(*[F.col(f"`{n}`") for n in schema.names]).alias("read_as")
    parsed = rows.select(read_as, F.col(BAD).alias("row"), F.input_file_name().alias("file"), F.col(BAD).isNull().alias("fits"))
    parsed.write.mode("overwrite").partitionBy("fits").parquet(parsed_path)
    back = spark.read.schema(parsed.schema).parquet(parsed_path)
    return back.where("fits").select("read_as.*"), back.where("not fits").select("file", "row", "read_as")


def read_diabetes_csv(spark: SparkSession, path: str) -> DataFrame:
    """The diabetes CSV with our canonical column names."""
    return read_csv(spark, path, schemas.diabetes_csv_schema()).withColumnsRenamed(schemas.diabetes_rename_map())


def snake(name: str) -> str:
    """``Heart_Attack_Risk`` / ``Heart Attack Risk`` -> ``heart_attack_risk``."""
    return "_".join(w for w in re.split(r"[^0-9A-Za-z]+", name.strip()) if w).lower()


def read_heart_csv(spark: SparkSession, path: str, rename: dict | None = None,
                   schema: T.StructType | None = None) -> DataFrame:
    """The heart CSV with snake_case names (``Patient_ID`` -> ``patient_id``).

    Its column list is not fixed upstream, so names come from the header and
    the type of each feature from ours (``heart_schema``); columns that we do
    not know stay text.  No pass over the data.  ``rename`` maps normalised
    names to ours where the file spells a feature differently; ``schema``
    gives other types for our names.
    """
    names = csv_header(spark, path)
    ours = {n: (rename or {}).get(snake(n), snake(n)) for n in names}
    types = {f.name: f.dataType for f in (schema or schemas.heart_schema()).fields}
    bound = T.StructType([T.StructField(n, types.get(ours[n], T.StringType()), True) for n in names])
    return read_csv(spark, path, bound).toDF(*ours.values())


def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    df.write.mode("overwrite").option("header", header).csv(path)


def write_processed(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """O-04: parquet, overwrite; ML vectors keep their type."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_processed(spark: SparkSession, path: str, vector_cols: tuple[str, ...] = ("features",)) -> DataFrame:
    """O-05: parquet source; a vector column that comes back as a struct
    or array is rebuilt as a vector with built-ins (no Python UDF)."""
    df = spark.read.parquet(path)
    for c in vector_cols:
        if c in df.columns and isinstance(df.schema[c].dataType, (T.StructType, T.ArrayType)):
            df = to_vector(df, c)
    return df


def identity(df: DataFrame) -> str:
    """Names, sizes and times of the files behind ``df``: another string when they change (metadata only)."""
    context = df.sparkSession.sparkContext
    out = []
    for name in sorted(df.inputFiles()):
        path = context._jvm.org.apache.hadoop.fs.Path(name)
        status = path.getFileSystem(context._jsc.hadoopConfiguration()).getFileStatus(path)
        out.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return hashlib.sha256("\n".join(out).encode()).hexdigest()
