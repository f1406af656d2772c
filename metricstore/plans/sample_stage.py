"""A module-style Python stage (``Loader().stage_class()`` protocol).

It registers the hourly 90th-percentile view of ``events`` that a following
SQL stage stores with ``select * from <view>``: user code makes views, the
store stays standard.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from metricstore.functions.timebins import bucket_epoch, metric_bucket
from metricstore.sources.python_stage import BaseLoader, BaseStage


class HourlyPercentileStage(BaseStage):
    """Arguments: ``source`` (table or view), ``view_name``, ``seconds``, ``percentile``."""

    def run(self, context, spark, stage, metric):
        source = self.args.get("source", "events")
        seconds = self.args.get("seconds")
        bucket = metric_bucket("ts", metric) if seconds is None and metric else bucket_epoch("ts", int(seconds or 3600))
        pct = float(self.args.get("percentile", 0.9))
        result = (
            spark.table(source)
            .groupBy(bucket.alias("measure_time"), "event_type")
            .agg(
                F.percentile_approx("value", pct).alias("val"),
                F.count(F.lit(1)).alias("sample_size"),
            )
        )
        result.createOrReplaceTempView(self.args.get("view_name", "hourly_percentile"))
        return None


class Loader(BaseLoader):
    def stage_class(self):
        return HourlyPercentileStage
