"""Stored steps: what is left of them after success and after an error."""

import pytest
from pyspark.sql import functions as F

from tidings.llm.tables import made_folder, stored, stored_alone


@pytest.fixture
def shared(tmp_path, monkeypatch):
    """Purposes of the folders that are in the shared folder."""
    monkeypatch.setattr("tidings.shared.shared_folder", lambda spark: str(tmp_path))
    return lambda: sorted(p.name.split("-")[0] for p in tmp_path.iterdir())


def test_steps_go_and_results_stay(spark, shared):
    def inner():
        return stored(spark.range(10), "a").where("id > 3")

    def outer():
        half = stored_alone(inner, "b")
        assert shared() == ["b"]
        other = made_folder(spark, "c")
        half.write.parquet(other)
        return half.unionByName(spark.read.parquet(other))

    found = stored_alone(outer, "d")
    assert shared() == ["d"]
    assert found.agg(F.sum("id")).first()[0] == 78
    stored(found, "e")
    assert shared() == ["d", "e"]


def test_steps_stay_after_an_error(spark, shared):
    def failing():
        stored(spark.range(3), "a")
        raise ValueError("stop")

    with pytest.raises(ValueError, match="stop"):
        stored_alone(failing, "b")
    assert shared() == ["a"]
    stored_alone(lambda: stored(spark.range(3), "c"), "d")
    assert shared() == ["a", "d"]


def test_no_rows(spark, shared):
    found = stored_alone(lambda: stored(spark.range(0), "a"), "b")
    assert found.count() == 0 and found.columns == ["id"] and shared() == ["b"]
