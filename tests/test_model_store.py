import pytest

from tidemill.operators import boosting as B
from tidemill.operators import model_store as M


def model(value):
    tree = [{"value": 0.0, "feature": 0, "bin": 0, "cut": 1.0, "missing_left": True, "gain": 1.0, "n": 2, "left": 1, "right": 2}, {"value": value}, {"value": -value}]
    return B.Model(("a",), [[1.0]], [B.Head("y", "t", "regression", trees=[tree])], B.Boost(trees=1))


def test_versions_promotion_and_rollback(spark, tmp_path):
    folder = f"file://{tmp_path}/models"
    with pytest.raises(FileNotFoundError, match="no promoted version"):
        M.load(spark, folder)
    one = M.save(spark, folder, model(1.0), {"y": 0.4}, {"rows": 7})
    assert M.pointer(spark, folder) is None
    M.promote(spark, folder, one, "monday")
    got, meta = M.load(spark, folder)
    assert got.heads[0].trees == model(1.0).heads[0].trees and meta["heads"]["y"]["threshold"] == 0.4 and meta["rows"] == 7
    with pytest.raises(ValueError, match="no version before"):
        M.rollback(spark, folder, "tuesday")
    two = M.save(spark, folder, model(2.0))
    M.promote(spark, folder, two, "tuesday")
    M.promote(spark, folder, two, "again")
    assert M.pointer(spark, folder) == {"version": two, "previous": one, "promoted_at": "tuesday"}
    with pytest.raises(FileNotFoundError):
        M.promote(spark, folder, "none", "never")
    assert M.load(spark, folder)[0].heads[0].trees[0][1]["value"] == 2.0
    assert M.rollback(spark, folder, "wednesday") == one and M.load(spark, folder)[0].heads[0].trees[0][1]["value"] == 1.0
    assert M.load(spark, folder, two)[1]["version"] == two
    df = spark.createDataFrame([(0.0,), (2.0,), (None,)], "a double")
    assert [r.pred_y for r in B.predict(df, M.load(spark, folder)[0]).collect()] == [1.0, -1.0, 1.0]
