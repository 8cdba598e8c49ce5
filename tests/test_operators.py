"""Generic operators: ties, NULLs, skew, partitioning."""

from __future__ import annotations

import hashlib
import random
import statistics
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from procurelens.functions import measures, parsing
from procurelens.operators import median
from procurelens.operators.bloom import bloom_filter, may_be_in
from procurelens.operators.joins import join_null_safe, unique_rows
from procurelens.operators.median import exact_median
from procurelens.operators.ranking import _ranged, ordered_position, tile_totals, top_k
from procurelens.operators.reshape import month_spine, open_pivot, reconcile
from procurelens.operators.shares import minmax_score, share_of_total
from tests.conftest import day, one, rows


def skewed_values(seed=7, n=400):
    """A third of the rows in one group, many ties, zeros, negatives and NULLs."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else f"g{rng.randrange(12)}"
        value = rng.choice([None, Decimal("0"), Decimal("5"), Decimal(rng.randrange(-900, 900)) / 4,
                            Decimal(rng.randrange(10**9)) / 100])
        out.append((group, f"id{i:04d}", value))
    return out


@pytest.fixture(scope="module")
def skewed(spark):
    return spark.createDataFrame(skewed_values(), "g string, id string, v decimal(12,2)")


@pytest.fixture
def ranges(spark):
    """Set how many ranges a whole order is cut into."""
    def cut(count):
        spark.conf.set("spark.sql.shuffle.partitions", count)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)

    yield cut
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", True)


def plain_positions(data, by, descending):
    groups = defaultdict(list)
    for g, i, v in data:
        groups[g if by else ""].append((i, v))
    out = []
    for members in groups.values():
        total = sum((v for _, v in members if v is not None), Decimal(0)) if any(
            v is not None for _, v in members) else None

        def key(row):
            i, v = row
            number = Decimal(0) if v is None else -v if descending else v
            return ((v is None) == descending, number, hashlib.md5(i.encode()).hexdigest(), i)

        running, seen, first = Decimal(0), object(), 0
        for place, (i, v) in enumerate(sorted(members, key=key), 1):
            running += v or 0
            if place == 1 or v != seen:
                seen, first = v, place
            out.append((i, place, first, len(members), running, total))
    return sorted(out, key=repr)


@pytest.mark.parametrize("count", [1, 2, 40])
@pytest.mark.parametrize("by", [[], ["g"]])
@pytest.mark.parametrize("descending", [True, False])
def test_positions_equal_plain_python(skewed, ranges, by, descending, count):
    ranges(count)
    placed = ordered_position(skewed, "v", ["id"], by=by, descending=descending, running=["v"])
    assert rows(placed, "id", "position", "tie_rank", "group_rows", "running_v",
                "total_v") == plain_positions(skewed_values(), by, descending)


def test_positions_of_groups_without_values(spark, ranges):
    ranges(7)
    data = [("a", f"i{n}", None) for n in range(30)] + [("b", "x", Decimal(1))]
    df = spark.createDataFrame(data, "g string, id string, v decimal(12,2)")
    placed = ordered_position(df, "v", ["id"], by=["g"], running=["v"])
    assert rows(placed, "id", "position", "tie_rank", "group_rows", "running_v",
                "total_v") == plain_positions(data, ["g"], True)
    assert ordered_position(df.limit(0), "v", ["id"], running=["v"]).collect() == []


@pytest.mark.parametrize("value", ["id % 20000", "5"])
def test_close_or_equal_values_spread_over_all_ranges(spark, ranges, value):
    """200,000 rows within 200 units, or of one value: no range holds more than its share."""
    ranges(16)
    df = spark.range(200_000).selectExpr("cast(id as string) id",
                                         f"cast(({value}) / 100 as decimal(10,2)) v")
    sizes = [r["count"] for r in _ranged(df, "v", ["id"], [], True).groupBy("_range").count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 200_000 / 16
    placed = ordered_position(df, "v", ["id"])
    assert one(placed.agg(F.count_distinct("position").alias("n"), F.min("position").alias("lo"),
                          F.max("position").alias("hi"))) == {"n": 200_000, "lo": 1, "hi": 200_000}


def test_position_has_no_window_over_all_rows(skewed):
    plan = ordered_position(skewed, "v", ["id"], running=["v"])._jdf.queryExecution().toString()
    whole = [text for text in plan.split("windowspecdefinition(")[1:] if text.startswith(("v#", "_tie"))]
    assert not whole  # every window over rows begins with the number of the range


@pytest.mark.parametrize("count", [1, 3, 20])
def test_tile_totals_equal_plain_tiles(spark, ranges, count):
    ranges(count)
    rng = random.Random(2)
    data = [("a", i, f"x{i}", 1) for i in range(8)] + [("b", 1, "y0", 1), ("b", 1, "y1", 2)]
    data += [("hot", rng.choice([1, 2, 2, 2, 2, 3]), f"h{i}", i) for i in range(300)]
    data += [(None, None, f"n{i}", i) for i in range(7)] + [("n", rng.choice([None, 4]), f"m{i}", i) for i in range(20)]
    df = spark.createDataFrame(data, "k string, q int, id string, w long")
    got = tile_totals(df, 3, ["k"], "q", ["id"], {"w_sum": F.col("w")})
    expected = []
    for k in {row[0] for row in data}:
        members = sorted((q is not None, q or 0, hashlib.md5(i.encode()).hexdigest(), w)
                         for g, q, i, w in data if g == k)
        size, extra = divmod(len(members), 3)
        for tile in (1, 2, 3):
            part, members = members[:size + (tile <= extra)], members[size + (tile <= extra):]
            if part:
                expected.append((k, tile, len(part), sum(m[3] for m in part)))
    assert rows(got, "k", "tile", "lines", "w_sum") == sorted(expected, key=repr)


@pytest.mark.parametrize("kind", ["decimal(10,2)", "decimal(18,4)"])
def test_median_is_exact(spark, kind):
    rng = random.Random(3)
    data = [("hot" if i % 3 else f"g{i % 7}", Decimal(rng.randrange(1, 9_999_999)) / 100)
            for i in range(501)] + [("two", Decimal("1.00")), ("two", Decimal("2.01")),
                                    ("tie", Decimal("5")), ("tie", Decimal("5")), ("nil", None)]
    df = spark.createDataFrame(data, "k string, v decimal(10,2)").withColumn(
        "v", F.col("v").cast(kind))
    got = {r["k"]: (r["median"], r["n"])
           for r in exact_median(df, ["k"], "v", count_out="n").collect()}
    groups = defaultdict(list)
    for k, v in data:
        if v is not None:
            groups[k].append(v)
    assert got == {k: (statistics.median(v), len(v)) for k, v in groups.items()}


def test_median_of_large_values_is_exact(spark):
    for low, high in (("900719925474.0993", "900719925474.0995"), ("99999999999999.1234", "99999999999999.1236")):
        df = spark.createDataFrame([(Decimal(low),), (Decimal(high),)], "v decimal(18,4)")
        assert one(exact_median(df, [], "v"))["median"] == (Decimal(low) + Decimal(high)) / 2


def test_weighted_global_median(spark):
    df = spark.createDataFrame([(Decimal("1"), 3), (Decimal("9"), 2), (Decimal("-4"), 1)],
                               "v decimal(10,2), w long")
    assert one(exact_median(df, [], "v", weight="w"))["median"] == 1


def weighted_median(pairs):
    return statistics.median([v for v, n in pairs for _ in range(n)])


@pytest.mark.parametrize("margin, room", [(1, 10**6), (0, 1), (1, 3)])
def test_median_when_brackets_miss_or_hold_too_much(spark, monkeypatch, margin, room):
    """Weights that the sketch does not know, one hot group, and brackets that are widened round by round."""
    monkeypatch.setattr(median, "ROOM", room)
    rng = random.Random(11)
    data = []
    for i in range(1500):
        price = Decimal(rng.randrange(1, 60_000)) / 100
        heavy = price > 590 or price < 3
        data.append(("hot" if i % 3 else rng.choice(["a", None]), price, rng.choice([200, 500]) if heavy else 1))
    data += [("same", Decimal("7.07"), 5)] * 40 + [("ends", Decimal(1), 4), ("ends", Decimal(2), 4),
                                                   ("none", None, 3), ("zero", Decimal(3), 0)]
    df = spark.createDataFrame(data, "k string, v decimal(10,2), w long")
    got = {r["k"]: (r["median"], r["n"])
           for r in exact_median(df, ["k"], "v", weight="w", count_out="n", margin=margin).collect()}
    groups = defaultdict(list)
    for k, v, w in data:
        if v is not None and w:
            groups[k].append((v, w))
    assert got == {k: (weighted_median(p), sum(w for _, w in p)) for k, p in groups.items()}


def test_median_of_nothing(spark):
    df = spark.createDataFrame([(None, 1)], "v decimal(10,2), w long")
    assert one(exact_median(df, [], "v", count_out="n")) == {"median": None, "n": None}
    assert exact_median(df.withColumn("k", F.lit(1)), ["k"], "v").collect() == []


def test_median_orders_only_rows_inside_the_bracket(spark):
    df = spark.range(100_000).select(F.lit("k").alias("k"), (F.col("id") / 100).cast("decimal(10,2)").alias("v"))
    result = exact_median(df, ["k"], "v")
    assert one(result)["median"] == Decimal("499.995")
    plan = result._jdf.queryExecution().toString()
    assert "percentile" not in plan


def test_top_k_ties(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 3)], "id string, v int")
    assert rows(top_k(df, 2, [F.desc("v"), F.asc("id")]), "id") == [("b",), ("d",)]
    ranked = top_k(df.withColumn("g", F.lit(1)), 2, [F.desc("v")], by=["g"], method="rank",
                   out="r")
    assert rows(ranked, "id", "r") == [("b", 2), ("c", 2), ("d", 1)]


def test_shares_and_scores(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("b", "x", 3.0), ("c", "y", 4.0)],
                               "id string, g string, v double")
    assert rows(share_of_total(df, "v"), "id", "pct_of_total") == [
        ("a", 12.5), ("b", 37.5), ("c", 50.0)]
    assert rows(share_of_total(df, "v", by="g"), "id", "pct_of_total") == [
        ("a", 25.0), ("b", 75.0), ("c", 100.0)]
    scored = minmax_score(df, {"up": ("v", "high"), "down": ("v", "low")})
    assert rows(scored, "id", "up", "down")[0] == ("a", 0.0, 100.0)
    single = minmax_score(df.where("id = 'a'"), {"up": ("v", "high")})
    assert rows(single, "up") == [(None,)]


def test_unique_rows_pass_or_fail_loudly(spark):
    sound = spark.createDataFrame([("a", 1, 2), ("b", None, 2)], "x string, y int, z int")
    assert rows(unique_rows(sound, ["x"], "things")) == rows(sound)
    assert rows(unique_rows(sound.select("x"), ["x"], "things")) == [("a",), ("b",)]
    assert unique_rows(sound.limit(0), ["x", "z"], "things").collect() == []
    for row, shown in (("a", "a"), (None, "missing")):
        broken = sound.unionByName(spark.createDataFrame([(row, 3, 4)], sound.schema))
        with pytest.raises(Exception, match=rf"things: key \({shown}\) is no key"):
            unique_rows(broken, ["x"], "things").collect()


def test_open_pivot_has_a_column_for_every_value(spark):
    df = spark.createDataFrame([("a", 10, 1.0), ("a", 9, 2.0), ("b", 10, 3.0), ("b", None, 4.0)],
                               "k string, c int, v double")
    wide = open_pivot(df, "k", "c", F.max("v"), "c_{}")
    assert wide.columns == ["k", "c_none", "c_9", "c_10"]
    assert rows(wide) == [("a", None, 2.0, 1.0), ("b", 4.0, None, 3.0)]


def test_bloom_filter_holds_back_no_member(spark):
    keys = spark.range(0, 3000, 3).select(F.col("id").cast("string").alias("k")).union(
        spark.createDataFrame([(None,)], "k string"))
    rows_ = spark.range(30_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("word"))
    rows_ = rows_.union(spark.createDataFrame([(None, 2)], "k string, word int"))
    passed = {r["k"] for r in may_be_in(rows_, "k", bloom_filter(keys, "k")).collect()}
    members = {r["k"] for r in keys.collect()}
    assert members <= passed and len(passed) < len(members) + 30
    assert may_be_in(rows_, "k", bloom_filter(keys.limit(0), "k")).collect() == []


def test_null_safe_join(spark):
    left = spark.createDataFrame([(None, 1), ("a", 2)], "k string, x int")
    right = spark.createDataFrame([(None, 10), ("a", 20)], "k string, y int")
    assert rows(join_null_safe(left, right, ["k"]), "x", "y") == [(1, 10), (2, 20)]


def test_month_spine_fills_gaps(spark):
    df = spark.createDataFrame([(day("2024-01-01"), 1), (day("2024-04-01"), 4)], "m date, v int")
    assert rows(month_spine(df, "m", "v"), "idx", "v") == [(1, 1), (2, None), (3, None), (4, 4)]


def test_reconcile_reports_missing_sides(spark):
    left = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "check string, value double")
    right = spark.createDataFrame([("a", 1.5), ("c", 2.0)], "check string, value double")
    assert rows(reconcile(left, right, 1.0), "check", "pass") == [
        ("a", True), ("b", False), ("c", False)]


def test_parsing(spark):
    df = spark.createDataFrame(
        [("2024-02-10",), (" 2024-02-10 ",), ("2024",), ("2024-2-5",), ("",), ("2024-13-45",),
         (None,), ("2024-02-1T",), ("12024-2-05",)], "t string")
    parsed = [r[0] for r in df.select(parsing.parse_date("t")).collect()]
    assert parsed == [day("2024-02-10"), day("2024-02-10"), None, None, None, None, None, None,
                      None]
    malformed = [r[0] for r in df.select(parsing.is_malformed_date("t")).collect()]
    assert malformed == [False, False, True, True, False, True, False, True, True]
    numbers = spark.createDataFrame([("12.345",), (" 7 ",), ("x",), ("",), ("999999999",)],
                                    "t string")
    assert [r[0] for r in numbers.select(parsing.parse_decimal("t")).collect()] == [
        Decimal("12.35"), Decimal("7.00"), None, None, None]


def test_spellings(spark):
    df = spark.createDataFrame([(" USD",), ("Us dollar",), ("EUR ",), ("",)], "c string")
    assert [r[0] for r in df.select(
        parsing.standardise("c", parsing.CURRENCY_SPELLINGS)).collect()] == [
        "USD", "USD", "EUR", None]


def test_measures(spark):
    df = spark.createDataFrame([(day("2024-01-31"), day("2024-02-01"), 1, 0)],
                               "a date, b date, x int, z int")
    got = df.select(measures.month_index("b", "a"), measures.ratio("x", "z"),
                    measures.percent("z", "x"),
                    measures.days_late("a", "b")).collect()[0]
    assert tuple(got) == (2, None, 0.0, 1)


def test_bands(spark):
    df = spark.createDataFrame([(0.94,), (0.95,), (1.05,), (1.06,)], "x double")
    labelled = df.select(measures.band("x", (("<", 0.95, "low"), ("<=", 1.05, "mid")), "high"))
    assert [r[0] for r in labelled.collect()] == ["low", "mid", "mid", "high"]
