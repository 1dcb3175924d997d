import pytest
from conftest import rows

from headway.operators.reshape import pivot_wider


def test_two_values_name_value_first(spark):
    long = spark.createDataFrame(
        [("a", "x", 1, 2), ("a", "y", 3, None), ("b", "x", 5, 6)], "id string, n string, e int, m int"
    )
    wide = pivot_wider(long, ["id"], "n", ["e", "m"], ["x", "y"])
    assert wide.columns == ["id", "e_x", "e_y", "m_x", "m_y"]
    assert rows(wide) == [("a", 1, 3, 2, None), ("b", 5, None, 6, None)]
    assert pivot_wider(long, ["id"], "n", ["e"]).columns == ["id", "x", "y"]


def test_repeated_cells_fail(spark):
    long = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "id string, n string, e int")
    with pytest.raises(Exception, match="several rows for one cell"):
        pivot_wider(long, ["id"], "n", ["e"], ["x"]).collect()


def test_missing_and_unlisted_names(spark):
    long = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "z", 3)], "id string, n string, e int")
    assert rows(pivot_wider(long, ["id"], "n", ["e"])) == [("a", 1, None, 2), ("b", None, 3, None)]
    with pytest.raises(Exception, match="not listed"):
        pivot_wider(long, ["id"], "n", ["e"], ["x"]).collect()
    assert rows(pivot_wider(long, ["id"], "n", ["e"], ["x"], leave_out=True)) == [("a", 1), ("b", None)]
