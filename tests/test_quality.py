import logging

import pytest

from eventlake.operators import (
    Check,
    DataQualityError,
    NotNull,
    RequiredColumns,
    Unique,
    audit,
    enforce,
)
from eventlake.operators.quality import check_count, duplicate_keys, null_counts


@pytest.fixture
def df(spark):
    return spark.createDataFrame(
        [("a", 1), ("a", 2), ("b", None), (None, 3), (None, 4), (None, 5)], "k string, v int"
    )


def counts(df, *rules):
    return {r.rule: r.violations for r in audit(df, rules).collect()}


def test_all_rules_at_once(df):
    got = counts(
        df,
        RequiredColumns(("k", "v", "w")),
        NotNull("k"),
        NotNull("v"),
        Check("positive", "v > 1"),
        Unique("k"),
        Unique("v"),
    )
    assert got == {
        "required_columns": 1,
        "not_null(k)": 3,
        "not_null(v)": 1,
        "check(positive)": 2,
        "unique(k)": 1,
        "unique(v)": 0,
    }


def test_row_rules_share_one_scan(df, tmp_path):
    path = str(tmp_path / "t")
    df.write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    plan = audit(stored, [NotNull("k"), NotNull("v"), Check("c", "v > 1")])
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_no_rules_and_no_rows(spark, df):
    assert counts(df) == {}
    assert counts(df.limit(0), NotNull("k"), Unique("k")) == {"not_null(k)": 0, "unique(k)": 0}


def test_enforce_names_table_rule_and_count(df):
    with pytest.raises(DataQualityError) as e:
        enforce(df, "db.t", [NotNull("k"), Unique("k"), Unique("v")])
    assert str(e.value) == (
        "DATA QUALITY FAILURE: db.t: not_null(k): 3 violations; unique(k): 1 violations"
    )
    with pytest.raises(DataQualityError, match="missing w, z"):
        enforce(df, "db.t", [RequiredColumns(("k", "z", "w"))])
    with pytest.raises(DataQualityError, match=r"not_null\(w\): no such column"):
        enforce(df, "db.t", [NotNull("w")])


def test_extra_columns_pass(df):
    assert enforce(df, "t", [RequiredColumns(("k",))]) == {}


def test_warn_mode_logs(df, caplog):
    with caplog.at_level(logging.WARNING):
        enforce(df, "db.t", [NotNull("k")], mode="warn")
    assert "DATA QUALITY FAILURE: db.t" in caplog.text
    with pytest.raises(ValueError):
        enforce(df, "db.t", [], mode="ignore")


def test_building_blocks(df):
    assert null_counts(df, ["k", "v"]).first().asDict() == {"k": 3, "v": 1}
    assert check_count(df, Check("c", "v >= 3")).first().violations == 3
    assert {tuple(r) for r in duplicate_keys(df, ["k"]).collect()} == {("a", 2), (None, 3)}
