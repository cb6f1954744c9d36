"""A keyed table that a stream keeps up to date: buckets of keys and a log of changes, named by one small state file.

A batch writes what it brought as one version of the log and then replaces the state file; what the state does not name
does not exist for readers. So a crash leaves either the old table or the new one, and no reader lists folders. After
COMPACT_AFTER versions the changes go into the buckets: only buckets with changed keys are read and written again.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.ingest import latest, upsert

BUCKETS = 64
COMPACT_AFTER = 16


@dataclass(frozen=True)
class State:
    """What is in the table. ``batch`` is the last batch of the stream with this checkpoint that counts."""

    checkpoint: str = ""
    batch: int = -1
    next_version: int = 0
    log: list[int] = field(default_factory=list)
    buckets: dict[str, int] = field(default_factory=dict)


def _state_path(root: str) -> str:
    return f"{root.rstrip('/')}/state.json"


def _hadoop(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def read_state(spark: SparkSession, root: str) -> State:
    where, files = _hadoop(spark, _state_path(root))
    if not files.exists(where):
        return State()
    return State(**json.loads(spark.read.text(_state_path(root), wholetext=True).first()[0]))


def commit(spark: SparkSession, root: str, state: State) -> None:
    """Replaces the state file in one step: a draft is written beside it and renamed over it."""
    draft, files = _hadoop(spark, f"{root.rstrip('/')}/_draft-{uuid.uuid4().hex}.json")
    out = files.create(draft, True)
    out.write(bytearray(json.dumps(asdict(state)).encode()))
    out.close()
    options = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(files.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration())
    context.rename(files.makeQualified(draft), files.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(_state_path(root))), over)


def _bucketed(df: DataFrame, key: str) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int"))


def _log_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/log/version={version}"


def _base_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/base/version={version}"


def _logged(spark: SparkSession, root: str, state: State) -> DataFrame:
    return spark.read.option("basePath", f"{root.rstrip('/')}/log").parquet(*[_log_path(root, v) for v in state.log])


def _base(spark: SparkSession, root: str, state: State, buckets: list[str]) -> DataFrame | None:
    """The buckets that exist, at most BUCKETS folders."""
    held = [b for b in buckets if b in state.buckets]
    parts = [f"{_base_path(root, state.buckets[b])}/bucket={b}" for b in held]
    return spark.read.option("recursiveFileLookup", True).parquet(*parts) if parts else None


def append(changes: DataFrame, root: str, key: str, order: list[str], checkpoint: str, batch: int) -> None:
    """Adds the changes of one batch of a stream; a batch that has been counted is not counted again."""
    spark = changes.sparkSession
    state = read_state(spark, root)
    if state.checkpoint == checkpoint and batch <= state.batch:
        return
    version = state.next_version
    _bucketed(changes, key).write.mode("overwrite").parquet(_log_path(root, version))
    state = replace(state, checkpoint=checkpoint, batch=batch, next_version=version + 1, log=[*state.log, version])
    commit(spark, root, state)
    if len(state.log) >= COMPACT_AFTER:
        compact(spark, root, key, order)


def current(spark: SparkSession, root: str, key: str, order: list[str]) -> DataFrame:
    """The buckets, replaced or extended by the changes logged after them."""
    state = read_state(spark, root)
    base = _base(spark, root, state, list(state.buckets))
    if not state.log:
        if base is None:
            raise FileNotFoundError(f"no table below {root}")
        return base
    return _merged(base, _logged(spark, root, state).drop("bucket"), key, order)


def _merged(base: DataFrame | None, logged: DataFrame, key: str, order: list[str]) -> DataFrame:
    ranked = ["version", *order]
    if base is None:
        return latest(logged, [key], ranked).drop(*ranked)
    return upsert(base, logged, [key], ranked)


def compact(spark: SparkSession, root: str, key: str, order: list[str]) -> list[int]:
    """Brings the log into the buckets that it touches and returns their numbers; other buckets stay as they are."""
    state = read_state(spark, root)
    if not state.log:
        return []
    logged = _logged(spark, root, state)
    touched = sorted(r[0] for r in logged.select("bucket").distinct().collect())  # at most BUCKETS
    base = _base(spark, root, state, [str(b) for b in touched])
    merged = _bucketed(_merged(base, logged.drop("bucket"), key, order), key)
    version = state.next_version
    merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(_base_path(root, version))
    commit(spark, root, replace(state, next_version=version + 1, log=[], buckets=state.buckets | {str(b): version for b in touched}))
    return touched
