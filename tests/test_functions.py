"""Column functions on literal rows."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from terraloom.functions import clean as C
from terraloom.functions import crs
from terraloom.functions import dates as D
from terraloom.functions import geometry as G
from terraloom.operators import dedupe, livestock, mapping, nitrogen, quality


def column(spark, f, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_cleaning(spark):
    assert column(spark, C.clean_text, [" a ", " b\n", " \t", "", None]) == ["a", "b", None, None, None]
    assert column(spark, C.to_int, [" 12 ", "12.5", "1_0", "-3", "x", None, "99999999999999999999"]) == [12, None, None, -3, None, None, None]
    assert column(spark, C.to_float, ["1,5", " 2.5 ", "x", "", None]) == [1.5, 2.5, None, None, None]
    assert column(spark, C.digits_to_float, ["1.200 kr", "kr", "1.2.3", None]) == [1.2, None, None, None]
    assert column(spark, C.is_true, ["TRUE", "false", None]) == [True, False, None]
    assert column(spark, C.yes_flag, ["Ja", "Nej", None]) == [1, 0, 0]
    assert column(spark, C.sand_falsk, ["SAND", "FALSK", "?", None]) == [True, False, None, None]
    assert column(spark, lambda c: C.lookup(c, {"a": "A"}, "Unknown"), ["a", "b", None]) == ["A", "Unknown", None]
    assert column(spark, C.peat_class, ["12", "60", None, "x"]) == ["6-12%", ">12%", None, None]
    assert C.sanitised("Areal (ha).x") == "Areal _ha__x" and C.sanitised("A b.C", True) == "a_b_c"


def test_bucket_ends_count_twice(spark):
    got = spark.createDataFrame([(v,) for v in (0, 100, 1000, 9999, 10000, 10001)], "v long").agg(*C.bucket_counts(F.col("v"))).head()
    assert list(got) == [2, 2, 1, 1, 1, 1]


def test_dates(spark):
    assert [x and x.date() for x in column(spark, D.day_first, ["31-12-2020", "01/02/2021", "3.4.2020", "2020-05-06", "x", None])] == [dt.date(2020, 12, 31), dt.date(2021, 2, 1), None, dt.date(2020, 5, 6), None, None]
    assert column(spark, D.epoch_millis, [0, None, 86_400_000], "long")[:2] == [None, None]
    assert column(spark, lambda c: F.date_format(D.iso_timestamp(c), "yyyy-MM-dd HH:mm"), ["2021-03-04T05:06:07Z", "bad"]) == ["2021-03-04 05:06", None]
    assert column(spark, D.plan_year, ["plan_2021_2022.csv"]) == ["2021-2022"]
    with pytest.raises(PySparkException, match="no plan year"):
        column(spark, D.plan_year, ["plan.csv"])
    first, last = D.trailing_year(F.col("v"))
    assert column(spark, lambda c: first, [dt.date(2024, 3, 31)], "date") == [dt.date(2023, 3, 1)]
    assert column(spark, lambda c: last, [dt.date(2024, 3, 31)], "date") == [dt.date(2024, 2, 29)]


def test_golden_reprojection(spark):
    df = spark.createDataFrame([(595970.0, 6401230.0)], "x double, y double").select(crs.to_wgs84(F.col("x"), F.col("y")).alias("p"))
    df = df.withColumn("back", crs.to_utm32(F.col("p.x"), F.col("p.y")))
    r = df.head()
    assert (r.p.x, r.p.y) == pytest.approx((10.6121587, 57.74290978), abs=1e-7)
    assert (r.back.x, r.back.y) == pytest.approx((595970, 6401230), abs=1e-3)
    out = spark.createDataFrame([(1.0, 2.0)], "x double, y double").select(crs.checked_point(F.col("x"), F.col("y")).alias("p")).head()
    assert out.p is None


def test_rings(spark):
    got = column(spark, lambda c: G.ring_of_positions(c, 3), ["0 0 9 0 1 9 1 1 9 1 0 9", "0 0 9 0 1 9", "0 x 9 0 1 9 1 1 9 1 0 9", None])
    assert [p.x for p in got[0]] == [0, 0, 1, 1, 0]
    assert got[1:] == [None, None, None]
    square = "array(named_struct('x', 0D, 'y', 0D), named_struct('x', 0D, 'y', 2D), named_struct('x', 2D, 'y', 2D), named_struct('x', 2D, 'y', 0D), named_struct('x', 0D, 'y', 0D))"
    r = spark.range(1).select(F.expr(square).alias("r")).select(G.is_ccw(F.col("r")).alias("ccw"), G.is_ccw(F.reverse("r")).alias("rev"), G.wkt(F.array(F.array("r"))).alias("t")).head()
    assert (r.ccw, r.rev) == (False, True)
    assert r.t == "MULTIPOLYGON (((0.0 0.0, 0.0 2.0, 2.0 2.0, 2.0 0.0, 0.0 0.0)))"


def test_mapping(spark):
    df = spark.createDataFrame([("1", None, "b2"), ("x", "b1", "b3")], "n string, Markblok string, MB_NR string")
    out = mapping.rename(df, {"Markblok": "block_id", "MB_NR": "block_id"})
    assert [r.block_id for r in out.collect()] == ["b2", "b1"]
    m = spark.range(1).select(mapping.open_map(F.array(F.lit("A"), F.lit("b"), F.lit("a")), F.array(F.lit("1"), F.lit(" "), F.lit("2"))).alias("m")).head().m
    assert m == {"a": "2"}
    s = spark.createDataFrame([(1, None), (2, (3,))], "k int, s struct<v:int>")
    assert [tuple(r) for r in mapping.flatten_struct(s, "s").orderBy("k").collect()] == [(1, None), (2, 3)]


def test_quality(spark):
    df = spark.createDataFrame([(1, None), (None, 2)], "a int, b int")
    with pytest.raises(ValueError, match="missing columns: c"):
        quality.assert_columns(df, ["a", "c"])
    with pytest.raises(ValueError, match="no rows"):
        quality.assert_not_empty(df.limit(0))
    ok, bad = quality.split_rejects(df, {"a": F.col("a") > 0})
    assert ok.count() == 1 and bad.head().reject_reason == "a"
    with pytest.raises(PySparkException, match="unexpected srid"):
        quality.assert_srid(df.withColumn("srid", F.lit(25832))).collect()
    assert [r.srid for r in quality.assert_srid(df.withColumn("srid", F.lit(None).cast("int"))).collect()] == [4326, 4326]


def test_numbered_is_dense_and_ordered(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7919 % 1000).alias("v")).repartition(5)
    got = dedupe.numbered(df, ["v"]).collect()
    assert sorted((r.id, r.v) for r in got) == [(i + 1, i) for i in range(1000)]


def test_livestock_edges_and_sizes(spark):
    assert column(spark, livestock.not_total, ["I alt", "i alt dyr", "Søer", None]) == [False, False, True, True]
    e = livestock.agreement_edges(spark.createDataFrame([(1, [2, 0, None])], "a long, m array<long>"), "a", "m")
    assert [tuple(r) for r in e.collect()] == [(1, 2)]
    h = spark.createDataFrame([(1, "x"), (2, "y")], "chr_number long, name string")
    p = spark.createDataFrame([(1, "z", "c")], "chr_number long, name string, city string")
    assert sorted(tuple(r) for r in livestock.join_herds(h, p).select("chr_number", "name", "city").collect()) == [(1, "z", "c"), (2, "y", None)]


def test_nitrogen_guards(spark):
    f = spark.createDataFrame([(1, 0.0, 0.0, None, 5.0, 1.0, 2.0, 2.0)], "CVR long, F_504_1 double, F_505_1 double, F_512 double, F_901 double, F_610 double, F_706_1 double, F_193 double")
    a = nitrogen.farm_accounts(f)
    r = a.head()
    assert (r.factor, r.performance) == (1.0, None)
    fields = spark.createDataFrame([(1, 10.0, 0.0)], "CVR long, n_kvote double, harmoni_areal double")
    assert nitrogen.field_accounts(a, fields).head().consumption is None


@pytest.mark.parametrize("shuffle", [1, 64])
def test_numbers_are_consecutive_over_many_partitions(spark, shuffle):
    """Two million rows, many ranges, adaptive plans: every number once, in order, and no row lost."""
    from terraloom.operators.dedupe import numbered

    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
    try:
        n = 2_000_000 if shuffle > 1 else 1000
        df = spark.range(0, n, 1, 13).select((F.col("id") % 3).alias("a"), F.sha1(F.col("id").cast("string")).alias("b"), F.lit("x").alias("part"), "id")
        out = numbered(df, ["a", "b"], "k")
        assert out.columns == [*df.columns, "k"]
        got = out.agg(F.count("*").alias("n"), F.count_distinct("k").alias("d"), F.min("k").alias("low"), F.max("k").alias("high")).head()
        assert tuple(got) == (n, n, 1, n)
        wrong = out.alias("u").join(out.alias("v"), F.expr("u.k + 1 = v.k")).where("(u.a, u.b) > (v.a, v.b)").count() if n < 5000 else 0
        assert wrong == 0
        thirds = out.groupBy("a").agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("*").alias("n")).orderBy("a").collect()
        assert all(r.high - r.low + 1 == r.n for r in thirds) and [r.low for r in thirds] == sorted(r.low for r in thirds)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    empty = numbered(spark.createDataFrame([], "a int, b string"), ["a"])
    assert empty.count() == 0
    nulls = numbered(spark.createDataFrame([(None,), (2,), (1,), (None,)], "a int"), ["a"]).collect()
    assert sorted((r.id, r.a) for r in nulls) == [(1, None), (2, None), (3, 1), (4, 2)]


def test_helper_columns_do_not_clash(spark):
    from terraloom.operators.dedupe import first_seen, sample_per_group

    df = spark.createDataFrame([(1, 5, "a"), (1, 4, "b"), (2, 1, "c")], "k int, rank int, _rank string")
    assert sorted(tuple(r) for r in first_seen(df, ["k"], ["rank"]).collect()) == [(1, 4, "b"), (2, 1, "c")]
    assert sample_per_group(df, ["k"], ["rank"], 5).count() == 3
