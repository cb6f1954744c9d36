"""Structured Streaming jobs over the batch operators.

Each run takes what has arrived (``availableNow``) and stops; the checkpoint makes the next run go on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from millrace.functions.expressions import unpack_json
from millrace.operators import ingest as ing
from millrace.operators import review as rv
from millrace.operators.metrics import band_of
from millrace.operators.models import with_probability
from millrace.operators.quality import align_features
from millrace.sources.feeds import ENVELOPE
from millrace.streaming import ledger

KEY, ORDER = "customer_id", ["page"]
EVENTS = "diff_id bigint, payload string, files string"


def _finish(writer: DataStreamWriter, checkpoint: str) -> None:
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def review_stream(events: DataFrame) -> DataFrame:
    """Webhook events to secret findings of the changed files in scope. Row-wise, so it keeps no state and
    shuffles nothing; each file of an event is its own diff."""
    files = rv.changed_files(rv.pr_events(events).select("diff_id", "login", "files"))
    return rv.scan_secrets(rv.review_inputs(files), keep=["diff_id", "diff_name", "login"])


def stream_reviews(spark: SparkSession, source: str, out: str, checkpoint: str, files_per_batch: int = 1000) -> DataFrame:
    events = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", files_per_batch).json(source)
    _finish(review_stream(events).writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)
    return spark.read.parquet(out)


def customer_batch(pages: DataFrame) -> DataFrame:
    """Typed good customers of a set of page envelopes, last page wins."""
    read = unpack_json(pages, F.col("value"), ENVELOPE).select("page", F.explode("data").alias("record"))
    names = [f.name for f in ing.CUSTOMER_TEXT.fields]
    good = ing.accepted(ing.typed_customers(ing.parse_customers(read, "record")))
    return ing.latest(good.select("page", *names), ["customer_id"], ["page"])


def stream_customers(spark: SparkSession, source: str, root: str, checkpoint: str, files_per_batch: int = 1000) -> DataFrame:
    """Every batch appends its changed rows to the table's log (see ``ledger``); a restart repeats nothing.

    A batch writes what it brought, not the whole table, and from time to time the log goes into the buckets it touches.
    """

    def log(batch: DataFrame, batch_id: int) -> None:
        ledger.append(customer_batch(batch), root, KEY, ORDER, checkpoint, batch_id)

    pages = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(source)
    _finish(pages.writeStream.foreachBatch(log), checkpoint)
    return current_customers(spark, root)


def current_customers(spark: SparkSession, root: str) -> DataFrame:
    return ledger.current(spark, root, KEY, ORDER)


def compact_customers(spark: SparkSession, root: str) -> list[int]:
    """Brings what is logged into the buckets now."""
    return ledger.compact(spark, root, KEY, ORDER)


def score_stream(rows: DataFrame, model: PipelineModel, features: Sequence[str], key: str) -> DataFrame:
    aligned = align_features(rows, features, [key])
    scored = with_probability(model, aligned, features, [key, "missing_features"])
    return scored.withColumn("risk_band", band_of(F.col("p")))


def stream_scores(
    spark: SparkSession, source: str, schema: str, out: str, checkpoint: str, model: PipelineModel,
    features: Sequence[str], key: str, files_per_batch: int = 1000,
) -> DataFrame:
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    scored = score_stream(rows, model, features, key)
    _finish(scored.writeStream.format("parquet").outputMode("append").option("path", out), checkpoint)
    return spark.read.parquet(out)
