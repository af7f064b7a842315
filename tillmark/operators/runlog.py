"""Run metrics as a table, and alert rules evaluated on it."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmark.schemas import RUN_METRICS


@dataclass
class RunRecord:
    """Counters and errors of one run, appended to the run-metrics table at its end.

    Row counts come from `observed` frames: they are collected by the write that
    runs anyway, not by extra jobs.
    """

    pipeline: str
    run_id: str
    metrics: dict[str, float] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    started: float = field(default_factory=time.time)
    _watched: list[Observation] = field(default_factory=list)

    def observed(self, df: DataFrame, **counters: Column) -> DataFrame:
        """The same frame; the counters are read when an action has run."""
        watch = Observation(f"{self.pipeline}_{len(self._watched)}")
        self._watched.append(watch)
        return df.observe(watch, *[c.alias(name) for name, c in counters.items()])

    def record(self, name: str, value: float) -> None:
        self.metrics[name] = float(value)

    def increment(self, name: str, by: float = 1) -> None:
        self.metrics[name] = self.metrics.get(name, 0.0) + float(by)

    def error(self, message: str) -> None:
        self.errors.append(message)

    def finish(self, spark: SparkSession, path: str, status: str = "success") -> DataFrame:
        if status == "success":
            for watch in self._watched:
                for name, value in watch.get.items():
                    self.increment(name, value or 0)
        elapsed = round(time.time() - self.started, 2)
        row = spark.createDataFrame(
            [(self.pipeline, self.run_id, status, elapsed, {**self.metrics, "elapsed_sec": elapsed}, self.errors, None)],
            RUN_METRICS).withColumn("finished_at", F.current_timestamp())
        row.write.mode("append").parquet(path)
        return row


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table.  Parquet counts come from file footers."""
    counts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
              for name, df in tables.items()]
    result = counts[0]
    for other in counts[1:]:
        result = result.unionByName(other)
    return result


# Metric, limit, seconds it must hold, severity.
ALERT_RULES = [
    ("KafkaConsumerLagHigh", "consumer_lag", 10000.0, 300, "warning"),
    ("PipelineETLFailed", "failed", 0.0, 0, "critical"),
    ("PipelineETLSlow", "elapsed_sec", 3600.0, 0, "warning"),
    ("DQCheckFailed", "dq_failed", 0.0, 0, "warning"),
]


def alerts(samples: DataFrame, rules: Sequence[tuple] = tuple(ALERT_RULES), interval_seconds: int = 300) -> DataFrame:
    """Alerts raised by metric samples (pipeline, metric, ts, value).

    A rule fires when its metric stays above the limit for so many seconds: samples
    above are grouped into runs by the count of samples below seen before them,
    and a run must span the time.  A silence longer than ``interval_seconds``, within
    which a sample is due, ends a run: nobody knows what the metric did.  Samples are first reduced to the worst per
    pipeline, metric and minute, which bounds every window; the few rules ride
    along as literals, so there is nothing to join.
    """
    minute = samples.groupBy("pipeline", "metric", F.date_trunc("minute", "ts").alias("minute")).agg(
        F.min("value").alias("lowest"), F.max("value").alias("highest"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    names = ("alert", "metric", "limit", "for_seconds", "severity")
    listed = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in rules])
    ruled = minute.withColumn("rule", F.explode(F.filter(listed, lambda rule: rule["metric"] == F.col("metric")))).select(
        *minute.columns, *[F.col(f"rule.{n}").alias(n) for n in names if n != "metric"])
    instant = ruled.filter("for_seconds = 0 and highest > limit").groupBy("alert", "severity", "pipeline").agg(
        F.count(F.lit(1)).alias("minutes"), F.max("highest").alias("worst"))
    silence = F.expr("unix_timestamp(cast(minute as timestamp)) - unix_timestamp(cast("
                     "lag(minute) over (partition by alert, pipeline order by minute) as timestamp))")
    over = F.expr(f"sum(case when lowest > limit and _silence <= {interval_seconds} then 0 else 1 end) over "
                  "(partition by alert, pipeline order by minute rows between unbounded preceding and current row)")
    runs = (
        ruled.filter("for_seconds > 0").withColumn("_silence", silence).withColumn("_run", over).filter("lowest > limit")
        .groupBy("alert", "severity", "pipeline", "for_seconds", "_run")
        .agg(F.count(F.lit(1)).alias("minutes"), F.max("highest").alias("worst"),
             F.min("first_ts").alias("since"), F.max("last_ts").alias("until"))
        .filter(F.unix_timestamp(F.col("until").cast("timestamp")) - F.unix_timestamp(F.col("since").cast("timestamp"))
                >= F.col("for_seconds"))
        .groupBy("alert", "severity", "pipeline").agg(F.sum("minutes").alias("minutes"), F.max("worst").alias("worst"))
    )
    return instant.unionByName(runs)
