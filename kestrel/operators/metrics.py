"""Classification quality: accuracy, confusion counts, per-class report.

One partial aggregate (label, pred) → counts; everything after works on
that table, whose size is bounded by (#classes)²."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(pred)).cast("double")).alias("accuracy"),
                  F.count(F.lit(1)).cast("bigint").alias("n"))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(pred).alias("prediction")).agg(
        F.count(F.lit(1)).cast("bigint").alias("n"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Rows per class (precision, recall, f1, support) plus 'accuracy',
    'macro avg', 'weighted avg'; 0/0 counts as 0."""
    cc = confusion_counts(df, label, pred)
    tp = cc.where(F.col("label") == F.col("prediction")).select(F.col("label").alias("cls"), F.col("n").alias("tp"))
    sup = cc.groupBy(F.col("label").alias("cls")).agg(F.sum("n").alias("support"))
    prd = cc.groupBy(F.col("prediction").alias("cls")).agg(F.sum("n").alias("predicted"))
    per = (sup.join(prd, "cls", "full_outer").join(tp, "cls", "left")
           .select(F.col("cls").cast("string").alias("cls"),
                   F.coalesce("tp", F.lit(0)).alias("tp"),
                   F.coalesce("support", F.lit(0)).alias("support"),
                   F.coalesce("predicted", F.lit(0)).alias("predicted")))
    safe = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    per = per.select("cls", safe(F.col("tp").cast("double"), F.col("predicted")).alias("precision"),
                     safe(F.col("tp").cast("double"), F.col("support")).alias("recall"),
                     F.col("support").cast("bigint").alias("support"), "tp")
    per = per.withColumn("f1", safe(2 * F.col("precision") * F.col("recall"),
                                    F.col("precision") + F.col("recall")))
    tot = per.agg(F.sum("support").alias("N"), F.sum("tp").alias("TP"),
                  F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    N = F.col("N").cast("double")

    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("cls"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        F.col("N").cast("bigint").alias("support"))

    summary = tot.select(F.inline(F.array(
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), F.col("TP") / N),
        row("macro avg", F.col("mp"), F.col("mr"), F.col("mf")),
        row("weighted avg", F.col("wp") / N, F.col("wr") / N, F.col("wf") / N))))
    return per.select("cls", "precision", "recall", "f1", "support").unionByName(summary)
