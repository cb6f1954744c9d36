"""Table sources and sinks: parquet, CSV, monthly files, versions, file catalog, schema contract."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ingest import CUSTOMER_TEXT
from millrace.operators.reports import concat

# Size classes in MB, file name parts
SMALL_MB, MEDIUM_MB = 50, 300
INPUT_TAG, OUTPUT_TAG, MATRIX_TAG = "_standardized", "_processed", "feature_matrix"
MATRIX_WIDTH = 10


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Inference reads the data twice; give a schema for large inputs."""
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def list_files(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Path and length of data files; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    return files.load(path).select("path", "length")


def read_monthly(spark: SparkSession, path: str, expect: int | None = None, mixed: bool = False) -> DataFrame:
    """All parquet files below ``path`` as one frame with lower-case names.

    ``expect`` checks the number of files. ``mixed`` allows per-file schemas (absent columns, other name
    case): the files, whose number the caller expects, become one union.
    """
    if expect is not None:
        found = list_files(spark, path).limit(expect + 1).count()
        if found != expect:
            raise ValueError(f"expected {expect} files in {path}, found {'more' if found > expect else found}")
    reader = spark.read.option("recursiveFileLookup", True)
    if not mixed:
        df = reader.parquet(path)
        return df.toDF(*[c.lower() for c in df.columns])
    paths = sorted(row["path"] for row in list_files(spark, path).collect())
    frames = [reader.parquet(p) for p in paths]
    return concat(*[f.toDF(*[c.lower() for c in f.columns]) for f in frames])


def read_customers(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """JSON customer records with the declared text schema.

    ``layout`` is 'lines' (one object per line, files are split) or 'array' (one array or object per file, which a
    single task reads).
    """
    if layout not in ("lines", "array"):
        raise ValueError(f"layout {layout!r} is neither 'lines' nor 'array'")
    return spark.read.schema(CUSTOMER_TEXT).option("multiLine", layout == "array").json(path)


def write_table(df: DataFrame, path: str, partitions: int | None = None) -> str:
    """Snappy parquet, overwriting ``path``.

    Without ``partitions`` AQE rebalances to even files from the measured size, splitting skewed ones, so
    no count is needed before the write. A fixed number deals the rows out evenly, which is a shuffle.
    """
    out = df.hint("rebalance") if partitions is None else df.repartition(partitions)
    out.write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def list_tables(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    """Path and length of the tables below ``path`` whose name fits ``pattern``: single files, and folders of part files.

    A folder whose name fits is one table, as long as all its files together; what lies in it is not looked at by name.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    base = root.getFileSystem(conf).makeQualified(root).toString().rstrip("/")
    named = jvm.org.apache.hadoop.fs.GlobPattern(pattern).compiled().pattern()
    below = F.split(F.substr(F.col("path"), F.lit(len(base) + 2)), "/")
    at = F.array_position(F.transform(below, lambda part: part.rlike(f"^(?:{named})$")), True)
    table = F.concat_ws("/", F.lit(base), F.slice(below, 1, F.greatest(at, F.lit(1)).cast("int")))
    return list_files(spark, path, "*").filter(at > 0).groupBy(table.alias("path")).agg(F.sum("length").alias("length"))


def catalog(spark: SparkSession, path: str, pattern: str = f"*{INPUT_TAG}.parquet") -> DataFrame:
    """Tables with size class, output name and kind by name, small to large."""
    name = F.element_at(F.split(F.col("path"), "/"), -1)
    size = F.col("length") / (1024 * 1024)
    kind = F.when(F.contains(F.lower("input"), F.lit(MATRIX_TAG)), "feature_matrix").otherwise("passthrough")
    order = F.when(size < SMALL_MB, 0).when(size < MEDIUM_MB, 1).otherwise(2)
    return (
        list_tables(spark, path, pattern)
        .select(
            "path",
            name.alias("input"),
            F.replace(name, F.lit(INPUT_TAG), F.lit(OUTPUT_TAG)).alias("output"),
            F.round(size, 1).alias("size_mb"),
            F.get(F.array(F.lit("small"), F.lit("medium"), F.lit("large")), order).alias("size_class"),
            order.alias("rank_"),
        )
        .withColumn("kind", kind)
        .orderBy("rank_", "input")
        .drop("rank_")
    )


def kind_by_schema(df: DataFrame) -> str:
    """A wide table with a client id is a feature matrix."""
    wide = len(df.columns) > MATRIX_WIDTH
    return "feature_matrix" if wide and any("client_id" in c for c in df.columns) else "passthrough"


def schema_contract(df: DataFrame) -> DataFrame:
    """Ordered names and types with the row and column count, in one count."""
    fields = df.schema.fields
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type"))
        for i, f in enumerate(fields)
    ]
    counted = df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(fields)).alias("columns"))
    return counted.select("rows", "columns", F.inline(F.array(*cells)))


def versions(spark: SparkSession, root: str) -> list[int]:
    """Completed versions below ``root``, ascending. A version counts once its commit marker exists."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(conf)
    if not fs.exists(base):
        return []
    names = [s.getPath() for s in fs.listStatus(base) if s.getPath().getName().startswith("version=")]
    done = [p for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(int(p.getName().split("=")[1]) for p in done)


def version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def full_refresh(df: DataFrame, root: str, version: int | None = None) -> int:
    """Replaces the table by writing a new version; readers keep the old one until the commit."""
    spark = df.sparkSession
    if version is None:
        version = max(versions(spark, root), default=0) + 1
    write_table(df, version_path(root, version))
    return version


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    done = versions(spark, root)
    if not done:
        raise FileNotFoundError(f"no completed version below {root}")
    return spark.read.parquet(version_path(root, done[-1]))
