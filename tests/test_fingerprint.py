"""The order-free fingerprint of a table."""

import math

from pyspark.sql import functions as F

from pricelab.sources import store as ST

SCHEMA = "id long, `a b` string, x double, tags array<string>"
ROWS = [(1, "a", 1.5, ["p", None]), (2, None, math.nan, []), (2, None, math.nan, []), (3, "", None, None), (4, "é\n\"", -0.1, [""])]


def _fp(spark, rows):
    return ST.table_fingerprint(spark.createDataFrame(rows, SCHEMA))


def test_order_and_layout_do_not_matter(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    same = df.repartition(3, "id").orderBy(F.col("id").desc()).select("tags", "x", "a b", "id")
    assert ST.table_fingerprint(df) == ST.table_fingerprint(same) and ST.table_fingerprint(df)[0] == 5


def test_changed_dropped_doubled_rows_show(spark):
    base = _fp(spark, ROWS)
    changed = [
        [(1, "a", 1.5, [None, "p"])] + ROWS[1:],
        [(1, None, 1.5, ["p", None])] + ROWS[1:],
        ROWS[:3] + [(3, None, None, None)] + ROWS[4:],
        ROWS[:1] + [(2, None, None, [])] + ROWS[2:],
        ROWS[1:], ROWS + ROWS[:1], [r for i, r in enumerate(ROWS) if i not in (1, 2)],
    ]
    prints = [_fp(spark, rows) for rows in changed]
    assert base not in prints and len(set(prints)) == len(prints)
    assert _fp(spark, []) == (0, 0, 0)


def test_differences_are_counted_only_where_tables_differ(spark):
    a = spark.createDataFrame(ROWS, SCHEMA)
    assert ST.round_trip_differences(a, a.repartition(2)) == (0, 0)
    assert ST.round_trip_differences(a, spark.createDataFrame(ROWS[1:] + ROWS[1:2], SCHEMA)) == (1, 1)
    assert ST.round_trip_differences(a.limit(0), a) == (0, 5)
