"""Composite jobs: feature-matrix and pass-through preparation of one table, and of a whole folder."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.operators.features import apply_labels, fit_labels
from millrace.operators.sampling import fraction_condition
from millrace.session import settle
from millrace.sources.tables import catalog, kind_by_schema, read_table, schema_contract, write_table

# Defaults of the preparation and of its model-ready variant
MISSING_PERCENT = 60.0
IQR_K = 1.5
OUTLIER_METHODS = ("none", "iqr_cap", "iqr_remove")
READY_KEYS = ("case_id",)


@dataclass(frozen=True)
class Config:
    required_columns: Sequence[str] = ()
    cast_rules: Mapping[str, str] = field(default_factory=dict)
    required_non_null: Sequence[str] = ()
    sample: float = 1.0
    sample_key: Sequence[str] = ()
    missing_percent: float = MISSING_PERCENT
    outlier_method: str = "none"  # one of OUTLIER_METHODS
    outlier_columns: Sequence[str] | None = None  # all numeric features
    iqr_k: float = IQR_K
    approx_quantiles: bool = False
    dedup_keys: Sequence[str] = ()
    dedup_order: Sequence[str] = ()

    def __post_init__(self) -> None:
        if self.outlier_method not in OUTLIER_METHODS:
            raise ValueError(f"outlier method {self.outlier_method!r} is not one of {', '.join(OUTLIER_METHODS)}")


def ml_ready(cfg: Config) -> Config:
    """Repeated cases removed and every numeric feature capped."""
    return replace(cfg, dedup_keys=READY_KEYS, outlier_method="iqr_cap")


def cast_rules(text: str) -> dict[str, str]:
    """Rules column: type from a JSON object."""
    rules = json.loads(text)
    if not isinstance(rules, dict) or not all(isinstance(v, str) for v in rules.values()):
        raise ValueError("cast rules are a JSON object of column names and type names")
    return rules


@dataclass(frozen=True)
class Prepared:
    """The prepared table, which is lazy, and what is counted while it is computed."""

    table: DataFrame
    counts: Sequence[Observation]
    facts: Mapping[str, object]

    def report(self) -> DataFrame:
        """One row about the table, from the counts of its first evaluation; nothing is computed again.

        To be asked for after an action that computes the whole table.
        """
        seen: dict[str, object] = {}
        for part in self.counts:
            seen |= part.get
        seen["rows_removed_outliers"] = seen["sampled_rows"] - seen["rows_after_outliers"]
        seen["rows_removed_dedup"] = seen.pop("rows_after_outliers") - seen["final_rows"]
        values = self.facts | seen
        row = [F.lit(v).cast("bigint" if k in seen else "int") if isinstance(v, int) else F.lit(v) for k, v in values.items()]
        return self.table.sparkSession.range(1).select(*[c.alias(k) for c, k in zip(row, values)])


class Watch:
    """Counts that are taken in passing, each under its own observation."""

    def __init__(self) -> None:
        self.counts: list[Observation] = []

    def __call__(self, df: DataFrame, **counts) -> DataFrame:
        self.counts.append(Observation())
        return df.observe(self.counts[-1], *[value.alias(name) for name, value in counts.items()])


def _rows():
    return F.count(F.lit(1))


def _facts(mode: str, base: DataFrame, final: DataFrame, cfg: Config, applied: Sequence[str], skipped: Sequence[str]) -> dict[str, object]:
    joined = lambda names: ",".join(names)
    return {
        "mode": mode,
        "initial_cols": len(base.columns),
        "final_cols": len(final.columns),
        "label_columns": joined(q.label_columns(base.columns)) if mode == "feature_matrix" else "",
        "cast_applied": joined(applied),
        "cast_skipped": joined(skipped),
        "dedup_keys_used": joined(k for k in cfg.dedup_keys if k in final.columns),
        "sample_fraction": float(cfg.sample),
        "missing_percent": float(cfg.missing_percent),
        "cast_rules": json.dumps(dict(cfg.cast_rules), sort_keys=True),
        "required_columns": joined(cfg.required_columns),
        "required_non_null": joined(cfg.required_non_null),
        "dedup_keys": joined(cfg.dedup_keys),
    }


def _sampled(base: DataFrame, cfg: Config, labeled, watch: Watch) -> tuple[DataFrame, DataFrame]:
    """The labelled, complete and sampled rows: as they are, for fits, and with counts, for the table."""
    complete = q.complete(base, cfg.required_non_null)
    keep = labeled & complete
    plain = base.filter(keep)
    key = list(cfg.sample_key) or [c for c in q.split_columns(base).ids if c not in q.label_columns(base.columns)]
    chosen = fraction_condition(plain, cfg.sample, key or base.columns)
    counted = watch(base, initial_rows=_rows(), rows_dropped_unlabeled=F.count_if(~labeled), rows_dropped_required_nulls=F.count_if(labeled & ~complete)).filter(keep)
    if chosen is not None:
        plain, counted = plain.filter(chosen), counted.filter(chosen)
    return plain, watch(counted, sampled_rows=_rows())


def prepare_matrix(df: DataFrame, cfg: Config) -> Prepared:
    """Casts, labels, required values, sample, sparse columns, fills, label codes, outliers, repeats.

    The order is part of the semantics: each fit sees the output of the steps before it. Fits read the input with as few
    columns as they need; the steps themselves run once, counted as they go.
    """
    q.require_columns(df, cfg.required_columns)
    base, applied, skipped = q.cast_columns(df, cfg.cast_rules)
    watch = Watch()
    plain, sampled = _sampled(base, cfg, q.labeled(base), watch)
    dropped = q.sparse_columns(plain, cfg.missing_percent)
    strings = q.split_columns(plain.drop(*dropped)).strings
    labels = fit_labels(q.fill_constant(plain.drop(*dropped)), strings) if strings else None
    filled = q.fill_constant(sampled.drop(*dropped))
    coded = apply_labels(filled, strings, *labels) if labels else filled
    bounds = q.Bounds()
    before = coded
    if cfg.outlier_method != "none":
        # The fences take passes of their own: the coded table is written once instead.
        coded = settle(coded, "coded")
        cols = q.outlier_columns(coded, cfg.outlier_columns)
        bounds = q.fit_iqr(coded, cols, cfg.iqr_k, approx=cfg.approx_quantiles)
        before = q.apply_cap(coded, bounds) if cfg.outlier_method == "iqr_cap" else coded.filter(q.within_fences(bounds))
    final = watch(q.dedup(watch(before, rows_after_outliers=_rows()), cfg.dedup_keys, cfg.dedup_order), final_rows=_rows())
    facts = _facts("feature_matrix", base, final, cfg, applied, skipped) | {
        "dropped_columns": ",".join(dropped),
        "encoded_columns": len(strings),
        "outlier_method": cfg.outlier_method,
        "outlier_columns": ",".join(sorted(bounds.fences)),
        "outlier_multiplier": float(cfg.iqr_k),
    }
    return Prepared(final, watch.counts, facts)


def prepare_passthrough(df: DataFrame, cfg: Config) -> Prepared:
    """Casts, required values, sample and repeats; nothing else changes."""
    q.require_columns(df, cfg.required_columns)
    base, applied, skipped = q.cast_columns(df, cfg.cast_rules)
    watch = Watch()
    _, sampled = _sampled(base, cfg, F.lit(True), watch)
    final = watch(q.dedup(watch(sampled, rows_after_outliers=_rows()), cfg.dedup_keys, cfg.dedup_order), final_rows=_rows())
    return Prepared(final, watch.counts, _facts("passthrough", base, final, cfg, applied, skipped))


def quality_report(df: DataFrame, cfg: Config, matrix: bool = True) -> DataFrame:
    """The report of a preparation whose table is computed once and thrown away."""
    prepared = (prepare_matrix if matrix else prepare_passthrough)(df, cfg)
    prepared.table.write.format("noop").mode("overwrite").save()
    return prepared.report()


def _run(prepared: Prepared, out: str) -> DataFrame:
    write_table(prepared.table, f"{out}/data")
    written = read_table(prepared.table.sparkSession, f"{out}/data")
    schema_contract(written).coalesce(1).write.mode("overwrite").json(f"{out}/contract")
    prepared.report().coalesce(1).write.mode("overwrite").json(f"{out}/report")
    return written


def run_feature_matrix(spark: SparkSession, path: str, out: str, cfg: Config) -> DataFrame:
    return _run(prepare_matrix(read_table(spark, path), cfg), out)


def run_passthrough(spark: SparkSession, path: str, out: str, cfg: Config) -> DataFrame:
    return _run(prepare_passthrough(read_table(spark, path), cfg), out)


def run_all(
    spark: SparkSession,
    folder: str,
    out: str,
    sample: float = 1.0,
    ready: bool = True,
    by: str = "name",
    pattern: str | None = None,
) -> DataFrame:
    """Prepares every file of a folder, small files first; one row per file with its outcome.

    ``by`` decides the kind of a file by its 'name' or its 'schema'. A failing file does not stop the rest.
    """
    files = catalog(spark, folder, pattern).collect() if pattern else catalog(spark, folder).collect()  # file names
    rows = []
    for file in files:
        matrix = file["kind"] == "feature_matrix"
        if by == "schema":
            matrix = kind_by_schema(read_table(spark, file["path"])) == "feature_matrix"
        cfg = Config(sample=sample)
        run, cfg = (run_feature_matrix, ml_ready(cfg) if ready else cfg) if matrix else (run_passthrough, cfg)
        target = f"{out}/{file['output']}"
        try:
            written = run(spark, file["path"], target, cfg).count()
            rows.append((file["input"], file["size_class"], "feature_matrix" if matrix else "passthrough", written, None))
        except Exception as exc:  # noqa: BLE001
            rows.append((file["input"], file["size_class"], "failed", None, f"{type(exc).__name__}: {exc}"))
    return spark.createDataFrame(rows, "input string, size_class string, kind string, rows bigint, error string")
