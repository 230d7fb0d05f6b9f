from basketry.functions.rates import safe_rate
from basketry.operators.segments import classify, occurrences, render_event_list
from basketry.operators.union import union_event_sets


def test_safe_rate_guards_null_and_zero_denominators(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (None, 4), (3, 4), (5, 4)], "n long, d long")
    got = [r.r for r in df.select(safe_rate("n", "d").alias("r")).collect()]
    assert got == [0.0, 0.0, None, 0.75, 1.25]
    unrounded = [r.r for r in df.select(safe_rate("n", "d", scale=None).alias("r")).collect()]
    assert unrounded[3] == 0.75


def test_classify_with_zero_counts_is_unknown(spark):
    df = spark.createDataFrame([(0, 0, 0), (0, 0, 1), (0, 2, 0), (1, 0, 0)], "p long, c long, v long")
    got = [r.s for r in df.select(classify("p", "c", "v").alias("s")).collect()]
    assert got == ["Unknown", "Window_Shopper", "Cart_Abandoner", "Buyer"]


def test_occurrences_of_empty_list(spark):
    df = spark.createDataFrame([([],)], "l array<struct<event_type:string,occurrences:long>>")
    row = df.select(occurrences("l", "view").alias("n"), render_event_list("l").alias("s")).collect()[0]
    assert (row.n, row.s) == (0, "")


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([("u1", "view")], "user_id string, event_type string")
    b = spark.createDataFrame([("purchase", "Toys", "u2")], "event_type string, category string, user_id string")
    rows = sorted(tuple(r) for r in union_event_sets([a, b]).select("user_id", "event_type", "category").collect())
    assert rows == [("u1", "view", None), ("u2", "purchase", "Toys")]
