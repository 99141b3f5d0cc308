import os

import pytest

from tidemark.session import materialize, scratch, tidied, tidy


def folder(df):
    return os.path.dirname(df.inputFiles()[0].removeprefix("file://"))


def test_tidy_deletes_what_is_not_kept(spark):
    with tidy(spark, "outer"):
        outer = materialize(spark.range(3), "outer")
        with tidy(spark, "inner"):
            inner, other = materialize(spark.range(4), "inner"), materialize(spark.range(5), "other")
            gone = folder(other)
        assert inner.count() == 4 and not os.path.exists(gone)
        there = folder(inner)
    assert outer.count() == 3 and not os.path.exists(there)
    assert scratch(spark, "x") != scratch(spark, "x")


def test_tidied_keeps_results_and_tidies_after_errors(spark):
    made = []

    @tidied("kept")
    def double(df, fail=False):
        made.append(folder(materialize(df, "step")))
        if fail:
            raise ValueError("no")
        return materialize(df.selectExpr("2 * id AS id"), "kept")

    assert [r.id for r in double(spark.range(3)).orderBy("id").collect()] == [0, 2, 4]
    with pytest.raises(ValueError):
        double(spark.range(3), fail=True)
    assert not any(map(os.path.exists, made))
