"""Plain Spark SQL forms of two reports, only for comparison in ``bench.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from footfall.operators import experiments
from workload import oracle
from workload.derive import AS_OF, TEST, Logs


def reach_union_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """22 SELECTs over the classified events."""
    Logs(spark, sf_dir).reach_events(None).createOrReplaceTempView("reach_all")
    return spark.sql(oracle.reach_summary_sql("reach_all").replace("isoyear(date + 1)", "extract(yearofweek from date + 1)").replace("week(date", "weekofyear(date").replace("as varchar", "as string"))


def ab_expanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users expanded by day and metric, the arms' statistics of each day joined to the control's."""
    logs = Logs(spark, sf_dir)
    expanded = experiments.user_cumulative_proportion(logs.conversions_by_user(), TEST, AS_OF)
    arms = expanded.groupBy("variation", "reporting_date", "metric_name").agg(
        F.count("*").alias("n"), F.avg("metric_value").alias("rate"), F.var_samp("metric_value").alias("variance")
    )
    control = arms.filter(F.col("variation") == TEST.control_variation).drop("variation")
    treated = arms.filter(F.col("variation") != TEST.control_variation)
    both = treated.join(control.withColumnsRenamed({c: f"{c}_con" for c in ("n", "rate", "variance")}), ["reporting_date", "metric_name"])
    return both.withColumn("diff", F.col("rate") - F.col("rate_con"))


FORMS = {"reach_overview_summary": reach_union_all, "ab_variant_results": ab_expanded}
