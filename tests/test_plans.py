"""Plan-shape checks on every registered query."""

import contextlib
import io

import pytest

from kestrel.plans import all_plans
from tests.conftest import SF001

PLANS = all_plans()
SKIP = {"classify_predict", "grid_search", "model_save", "truncated_svd"}  # fitted inside the plan builder


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(n for n in PLANS if n not in SKIP))
def test_no_cross_or_nested_loop_join(spark, name):
    text = _plan(PLANS[name].fn(spark, SF001))
    assert "BroadcastNestedLoopJoin" not in text and "CartesianProduct" not in text


def test_hazard_windows_are_bucket_partitioned(spark):
    from pyspark.sql import functions as F
    from kestrel.operators import reliability as rel
    df = spark.range(20_000).select((F.col("id") % 5000).cast("double").alias("CYCLE"),
                                    F.when(F.col("id") % 3 == 0, rel.FAILURE).otherwise(rel.SURVIVOR).alias("EVENT"))
    text = _plan(rel.hazard_table(df, keys_per_bucket=500))
    assert "hashpartitioning(_kestrel_bucket" in text


def test_scan_pushdown(spark):
    text = _plan(PLANS["filter_eq"].fn(spark, SF001))
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_linestatus:string>" in text


def test_building_a_plan_runs_nothing_below_a_shuffle(spark):
    """Row-wise helpers decide their parallelism without running the input."""
    from pyspark.sql import functions as F
    from kestrel.operators import retrieval as rt
    from kestrel.operators import textml as tm
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(x):
        calls.add(1)
        return str(x)

    df = spark.range(200).groupBy((F.col("id") % 50).alias("k")).agg(F.max("id").alias("m")).withColumn("text", counted("m"))
    tokens = tm.tokenize_content_words(df, "text", "toks", "list")
    chunks = rt.fixed_chunks(df, "text", 2, 0)
    pages = rt.html_element_text(df.withColumnRenamed("text", "html"), "ad")
    assert calls.value == 0
    assert tokens.count() == 50 and chunks.count() > 0 and pages.count() == 50


def test_shared_folder_is_required_off_a_local_master(spark, monkeypatch):
    from kestrel import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(Session())
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        session.scratch_path(Session(), "x")


def test_scratch_tables_can_be_cleaned(spark, monkeypatch):
    from kestrel import session
    monkeypatch.setattr(session, "_SCRATCH", [])
    path = session.scratch_path(spark, "t")
    spark.range(3).write.parquet(path)
    assert session.clean_scratch(spark) == 1 and session.clean_scratch(spark) == 0
    from pyspark.errors import AnalysisException
    with pytest.raises(AnalysisException):
        spark.read.parquet(path)


def test_hot_keys_are_not_shuffled(spark):
    """One key at 90 % of the rows is joined by broadcast; results are those of a plain join."""
    from pyspark.sql import functions as F
    from kestrel.operators.skew import hot_key_join
    rows = spark.range(20_000).select(F.when(F.col("id") % 10 > 0, -1).otherwise(F.col("id")).alias("k"), "id")
    keyed = rows.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    out = hot_key_join(rows, keyed, ["k"], "n", hot_rows=1000)
    assert "Union" in _plan(out) and "BroadcastHashJoin" in _plan(out)
    plain = rows.join(keyed.drop("n"), "k")
    assert sorted(map(tuple, out.select("k", "id", "v").collect())) == sorted(map(tuple, plain.select("k", "id", "v").collect()))
    assert "Union" not in _plan(hot_key_join(rows, keyed, ["k"], "n"))


def test_hot_cycle(spark):
    """90 % of the rows share one cycle: ranks and hazard rows are the definition's."""
    from pyspark.sql import functions as F
    from kestrel.operators import reliability as rel, skew, windows
    df = spark.range(3000).select(F.when(F.col("id") % 10 > 0, 5.0).otherwise(F.col("id").cast("double")).alias("CYCLE"),
                                  F.when(F.col("id") % 2 == 0, rel.FAILURE).otherwise(rel.SURVIVOR).alias("EVENT"))
    old, skew.HOT_ROWS = skew.HOT_ROWS, 100
    try:
        ranks = windows.rank_average_desc(df, "CYCLE").toPandas()
        rows = rel.hazard_rows(df, rel.hazard_table(df)).toPandas()
    finally:
        skew.HOT_ROWS = old
    want = ranks["CYCLE"].rank(method="average", ascending=False)
    assert len(ranks) == len(rows) == 3000 and (ranks["rank"] == want).all()
    assert (rows["risk"] == rows["CYCLE"].rank(method="average", ascending=False)).all()
