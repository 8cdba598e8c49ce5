"""What staging exchanges on the way to its queries, with joins that exchange their sides as those of large tables do."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from procurelens.plans import cleaning, quality
from procurelens.sources import order_lines, tables
from tests.conftest import SMALLEST

LARGE = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.files.maxPartitionBytes": "8k", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def large(spark):
    before = {k: spark.conf.get(k) for k in LARGE}
    for k, v in LARGE.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", df._jdf.queryExecution().executedPlan().toString())


def test_staging_is_not_run_to_be_opened(spark, large):
    context = spark.sparkContext
    context.setJobGroup("staging-opened", "")
    try:
        order_lines.staging_lines(spark, SMALLEST)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert not context.statusTracker().getJobIdsForGroup("staging-opened")


@pytest.mark.parametrize("plan", [lambda s: s, cleaning.deduplicate, quality.exact_duplicates])
def test_lines_are_exchanged_by_part_and_order_only(spark, large, plan):
    keys = sorted(re.sub(r"#\d+L?", "", k) for k in exchanges(plan(order_lines.staging_lines(spark, SMALLEST))))
    assert keys == ["_po", "c_custkey", "l_partkey", "o_custkey", "p_partkey", "po_id"]


def test_whole_lines_are_not_exchanged_for_collisions(spark, large):
    found = exchanges(quality.id_collisions(order_lines.staging_lines(spark, SMALLEST)))
    assert len(found) == 8 and not any("vendor_id" in k and "po_id" in k.split(", ")[0] for k in found)


def nodes(plan, name):
    below = [n for i in range(plan.children().size()) for n in nodes(plan.children().apply(i), name)]
    return [plan, *below] if plan.nodeName() == name else below


def test_lines_meet_headers_with_one_form_of_the_order_key(spark, large):
    plan = order_lines.staging_lines(spark, SMALLEST)._jdf.queryExecution().optimizedPlan()
    by_po = [join for join in nodes(plan, "Join") if "_po#" in join.condition().toString()]
    carried = by_po[0].left().output().mkString(",")
    assert len(by_po) == 1 and "po_id#" in carried and "l_orderkey#" not in carried


def test_faulty_lines_are_exchanged_with_one_copy_of_their_id(spark, large):
    plan = cleaning.clean_fact(order_lines.staging_lines(spark, SMALLEST))._jdf.queryExecution().optimizedPlan().toString()
    versions = re.findall(r"min\(struct\(badness_score, (.*?)\)\)", plan)
    assert versions and not any("po_line_id" in version for version in versions)


def test_files_of_staging_and_of_tables_are_packed(spark, tmp_path):
    staged = spark.createDataFrame([(" a", ""), ("b ", None), (None, "\"x,\""), ("x", " ")], "p string, q string").repartition(2)
    tables.write_staging(staged, str(tmp_path / "csv"))
    tables.write_table(staged, str(tmp_path / "plain"))
    tables.write_table(staged, str(tmp_path / "parts"), "q")
    written = [f.name for f in tmp_path.rglob("part-*")]
    assert len(written) >= 4 and all(name.endswith((".csv.gz", ".zstd.parquet")) for name in written)
    back = tables.read_staging(spark, str(tmp_path / "csv"), staged.columns)
    assert sorted(map(repr, back.collect())) == sorted(
        map(repr, staged.replace("", None).collect()))
    assert all(f.endswith(".zstd.parquet") for f in tables.working_set(staged, "packed").inputFiles())


def test_large_and_small_plans_agree(spark):
    small = order_lines.staging_lines(spark, SMALLEST)
    ways = [cleaning.clean_fact, cleaning.deduplicate, quality.exact_duplicates, quality.id_collisions]
    expected = [sorted(map(repr, way(small).collect())) for way in ways]
    before = {k: spark.conf.get(k) for k in LARGE}
    try:
        for k, v in LARGE.items():
            spark.conf.set(k, v)
        large = order_lines.staging_lines(spark, SMALLEST)
        assert [sorted(map(repr, way(large).collect())) for way in ways] == expected
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_collisions_without_a_po_id(spark):
    rows = [("1", None, "a"), ("1", "", "a"), ("2", None, "a"), ("2", "", "b"), ("3", None, "a"), ("3", "p", "a"),
            ("4", "p", None), ("4", "p", ""), ("5", "p", "a"), ("5", "q", "a"), ("5", "q", "a"), (None, "p", "a"), (None, "p", "b")]
    staging = spark.createDataFrame(rows, "po_line_id string, po_id string, vendor_id string")
    found = quality.id_collisions(staging, columns=staging.columns)
    assert {tuple(r) for r in found.collect()} == {("2", 2, 2), ("3", 2, 2), ("5", 3, 2), (None, 2, 2)}
    old = staging.fillna("", ["po_id", "vendor_id"]).groupBy("po_line_id").agg(
        F.count(F.lit(1)), F.count_distinct("po_id", "vendor_id").alias("v")).where("v > 1")
    assert {tuple(r) for r in old.collect()} == {tuple(r) for r in found.collect()}


SCORED = [("alone", 2, "a"), ("sound", 0, "a"), ("sound", 0, "b"), ("sound", 1, "c"), ("faulty", 2, "a"), ("faulty", 1, "c"),
          ("faulty", 1, "b"), (None, 1, "a"), (None, 0, "b"), ("", 3, "a"), ("good", 0, None), ("nulls", 1, None), ("nulls", 1, "a")]


def test_only_faulty_lines_of_contested_ids_are_exchanged_whole(spark, tmp_path):
    rows = SCORED + [(f"f{i}", 1, "x" * 50) for i in range(500)] + [(f"s{i}", 0, "y") for i in range(500)]
    spark.createDataFrame(rows, "k string, score int, v string").repartition(4).write.parquet(str(tmp_path / "scored"))
    left = cleaning.resolve_collisions(spark.read.parquet(str(tmp_path / "scored")), "k", "score")
    expected = [("alone", 2, "a"), ("sound", 0, "a"), ("sound", 0, "b"), ("faulty", 1, "b"), (None, 0, "b"), ("", 3, "a"),
                ("good", 0, None), ("nulls", 1, None), *rows[len(SCORED):]]
    assert sorted(map(repr, (tuple(r) for r in left.collect()))) == sorted(map(repr, expected))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = cleaning.resolve_collisions(spark.read.parquet(str(tmp_path / "scored")), "k", "score")
        plan = left._jdf.queryExecution().executedPlan()
        left._jdf.queryExecution().toRdd().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    whole = [n for n in nodes(plan, "Exchange") if "min#" in n.output().mkString(",")]
    sent = [n.metrics().apply("shuffleRecordsWritten").value() for n in whole]
    assert len(sent) == 1 and sent[0] < 50, sent  # the 500 faulty lines alone with their id are not among them


def test_ids_of_faulty_lines_are_exchanged_once(spark):
    rows = spark.createDataFrame(SCORED, "k string, score int, v string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = cleaning.resolve_collisions(rows, "k", "score")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    own = [text for text in plan.splitlines() if "Exchange hashpartitioning(_key" in text and "ReusedExchange" not in text]
    assert len(own) == 3, plan  # faulty ids, sound ids, rows of contested ids


def test_a_partitioned_table_is_written_without_an_exchange(spark, tmp_path):
    table = spark.range(0, 400, 1, 4).selectExpr("id", "id % 3 as part")
    context = spark.sparkContext
    context.setJobGroup("partitioned", "")
    try:
        tables.write_table(table, str(tmp_path / "parts"), "part")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    jobs = context.statusTracker().getJobIdsForGroup("partitioned")
    assert [len(context.statusTracker().getJobInfo(j).stageIds) for j in jobs] == [1]
    files = [f.parent.name for f in (tmp_path / "parts").rglob("part-*.parquet")]
    assert sorted(set(files)) == ["part=0", "part=1", "part=2"] and len(files) <= 12
    back = tables.read_table(spark, str(tmp_path / "parts"), table.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, table.collect()))
