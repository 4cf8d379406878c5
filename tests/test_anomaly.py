from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from txnlytics.operators import anomaly, iforest
from txnlytics.params import Params

FACTS = "txn_id int, date date, amount double, category string"
DETECTIONS = "txn_id int, method string, severity string, reason string, z_score double"


def facts(spark, amounts, category="Food", start=0):
    rows = [(start + i, date(2024, 1, 1 + i % 28), float(a), category) for i, a in enumerate(amounts)]
    return spark.createDataFrame(rows, FACTS)


@pytest.fixture(scope="module")
def outlier(spark):
    return facts(spark, [900 + 10 * i for i in range(20)] + [85000])


class TestZscore:
    def test_only_the_outlier(self, outlier):
        rows = anomaly.zscore_outliers(outlier).collect()
        assert [(r.txn_id, r.method, r.severity) for r in rows] == [(20, "zscore", "medium")]

    def test_reason(self, outlier):
        reason = anomaly.zscore_outliers(outlier).first().reason
        amounts = np.array([900 + 10 * i for i in range(20)] + [85000], dtype=float)
        mean = amounts.mean()
        z = (85000 - mean) / amounts.std()
        assert reason == (
            f"Amount Rs 85,000 is {z:.1f} standard deviations above the Food category mean of "
            f"Rs {mean:,.0f}. Deviation: Rs {85000 - mean:+,.0f}."
        )

    def test_low_side_is_flagged_too(self, spark):
        row = anomaly.zscore_outliers(facts(spark, [1000 + i for i in range(20)] + [1])).first()
        assert row.txn_id == 20 and "Deviation: Rs -" in row.reason

    def test_tiny_and_constant_groups(self, spark):
        df = facts(spark, [100, 50000], "tiny").unionByName(facts(spark, [5] * 30, "same", 100))
        assert anomaly.zscore_outliers(df).count() == 0

    @pytest.mark.parametrize("others, flagged", [(6, 0), (7, 1)])
    def test_smallest_group_that_can_flag(self, spark, others, flagged):
        assert anomaly.zscore_outliers(facts(spark, [1] * others + [10_000])).count() == flagged

    def test_missing_category_is_a_group(self, spark):
        df = facts(spark, [1] * 20 + [10_000], None)
        assert "Uncategorized" in anomaly.zscore_outliers(df).first().reason

    def test_partitioning_does_not_matter(self, outlier):
        assert anomaly.zscore_outliers(outlier.repartition(7)).collect() == anomaly.zscore_outliers(outlier).collect()

    def test_facts_are_not_shuffled(self, spark, tmp_path):
        path = str(tmp_path / "facts")
        spark.range(1000).select(
            F.col("id").alias("txn_id"), F.lit(date(2024, 1, 1)).alias("date"), F.rand(1).alias("amount"),
            F.lit("x").alias("category"),
        ).write.parquet(path)
        plan = anomaly.zscores(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


class TestMerge:
    def merged(self, spark, first, second):
        z = spark.createDataFrame(first, DETECTIONS)
        f = spark.createDataFrame(second, DETECTIONS)
        return {r.txn_id: r for r in anomaly.merge_detections(z, f).collect()}

    def test_disjoint(self, spark):
        got = self.merged(spark, [(1, "zscore", "low", "z", 2.6)], [(2, "isolation_forest", "medium", "f", None)])
        assert (got[1].method, got[1].severity, got[1].z_score) == ("zscore", "low", 2.6)
        assert (got[2].method, got[2].severity, got[2].z_score) == ("isolation_forest", "medium", None)

    def test_both(self, spark):
        got = self.merged(spark, [(5, "zscore", "low", "z", 2.6)], [(5, "isolation_forest", "medium", "f", None)])
        assert len(got) == 1
        assert (got[5].method, got[5].severity, got[5].z_score) == ("both", "high", None)
        assert got[5].reason == "CONFIRMED by both Z-score and Isolation Forest. z"

    def test_same_method_twice(self, spark):
        got = self.merged(spark, [(5, "zscore", "low", "a", 2.6), (5, "zscore", "medium", "b", 4.0)], [])
        assert (got[5].method, got[5].severity, got[5].reason) == ("zscore", "medium", "b")


@pytest.fixture(scope="module")
def crowd(spark):
    rng = np.random.default_rng(1)
    return facts(spark, [*rng.normal(1000, 50, 1000), 500_000, 800_000]).cache()


class TestForest:
    def test_too_few_rows(self, spark):
        assert iforest.forest_outliers(facts(spark, range(9))).count() == 0

    def test_planted_outliers_and_share(self, crowd):
        rows = {r.txn_id: r for r in iforest.forest_outliers(crowd).collect()}
        assert {1000, 1001} <= set(rows)
        assert 0.03 < len(rows) / 1002 <= 0.051
        assert rows[1001].reason.startswith("Isolation Forest detected unusual pattern. Transaction amount Rs 800,000 on ")

    def test_partitioning_does_not_matter(self, crowd):
        few = Params(trees=20)
        columns = ("txn_id", "severity", "reason")
        one = sorted(iforest.forest_outliers(crowd, few).select(*columns).collect())
        assert sorted(iforest.forest_outliers(crowd.repartition(9), few).select(*columns).collect()) == one

    @pytest.mark.parametrize("trees, size", [(4, 32), (100, 256)])
    def test_sample_sizes(self, spark, trees, size):
        """Both draws give every tree about twice its rows (or all there are)."""
        points = iforest.features(facts(spark, range(1000)))
        p = Params(trees=trees, tree_rows=size)
        sizes = [r["count"] for r in iforest.sample_rows(points, 1000, p).groupBy("tree").count().collect()]
        assert len(sizes) == trees and min(sizes) >= size
        assert abs(np.mean(sizes) - min(1000, 2 * size)) < 0.25 * size

    def test_repeated_id_cannot_swell_a_tree(self, spark):
        df = facts(spark, range(500)).unionByName(facts(spark, [1] * 2000).withColumn("txn_id", F.lit(1)))
        sizes = iforest.sample_rows(iforest.features(df), 2500, Params(trees=2, tree_rows=64)).groupBy("tree", "txn_id").count()
        assert sizes.agg(F.max("count")).first()[0] == 1

    def test_offset_is_the_exact_percentile(self, spark):
        scores = np.round(np.random.default_rng(3).uniform(-1, 0, 777), 6)
        df = spark.createDataFrame([(float(s),) for s in scores], "score double")
        assert abs(iforest.contamination_offset(df) - np.percentile(scores, 5)) < 1e-12

    def test_expected_path(self):
        assert iforest.expected_path(1) == 0 and iforest.expected_path(2) == 1
        assert abs(iforest.expected_path(256) - 10.2448) < 1e-3

    def test_scores_against_plain_traversal(self, crowd):
        p = Params(trees=5, tree_rows=64)
        points = iforest.features(crowd)
        forest = iforest.build_forest(points, 1002, p).cache()
        nodes = {(r.tree, r.node): r for r in forest.collect()}
        got = iforest.score_forest(points, forest, 1002, p).select("txn_id", *iforest.FEATURES, "score").collect()
        for row in got[::97] + got[-2:]:
            paths = []
            for tree in range(5):
                node = nodes[tree, 1]
                while node.feature >= 0:
                    left = row[1 + node.feature] <= node.threshold
                    node = nodes[tree, 2 * node.node + (not left)]
                paths.append(node.path)
            want = -(2 ** (-np.mean(paths) / iforest.expected_path(64)))
            assert row.score == pytest.approx(want, abs=1e-6)
