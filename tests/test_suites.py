"""The combined column checks against the single ones, and the size of the catalogue."""

from strandline.operators import quality as qa
from strandline.operators import suites


def test_column_checks_equal_the_single_checks(spark):
    df = spark.createDataFrame([(1, "x", None, [1]), (2, "x", None, [1]), (None, None, None, [1])],
                               "a int, b string, c string, d array<int>")
    for rows in (df, df.where("a = 1"), df.where("false")):
        columns = qa.other_columns(rows, ["a"])
        got = {r["check_name"]: r["n_violations"] for r in qa.column_checks(rows, {
            "nulls": ("no_null", ["a", "b", "d"]), "empty": ("only_null", columns), "one": ("same_value", columns)}).collect()}
        assert got == {"nulls": qa.no_null(rows, ["a", "b", "d"]).count(), "empty": qa.only_null(rows, ["a"]).count(),
                       "one": qa.same_value(rows, ["a"]).count()}


def test_the_catalogue_is_whole():
    assert 1 + len(suites.NO_DUPLICATES) + len(suites.INCLUDED) + len(suites.SAME_SET) == 22
    assert 3 + len(suites.NO_NULL) + 2 * len(suites.BLOCKS) + len(suites.DICTIONARIES) == 42
