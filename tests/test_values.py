"""Fixed examples of value conversion."""

import pytest
from pyspark.sql import functions as F

from changeflow.functions import scn as scnf, values as v
from changeflow.operators import history, typed
from changeflow.operators.typed import ColumnSpec, Options


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "expr, text, want",
    [
        (v.to_year_month, "1-6", 47336400000000),
        (v.to_year_month, "-1-6", -47336400000000),
        (v.to_year_month, "5000000", 5000000),
        (v.to_day_second, "1 2:30:45.123456", 95445123456),
        (v.to_day_second, "-1 2:30:45.5", -95445500000),
        (v.to_day_second, "junk", None),
        (lambda x: v.to_year_month(x, "string"), "1-6", "P1Y6M0DT0H0M0S"),
        (lambda x: v.to_day_second(x, "string"), "1 2:30:45.123456", "P0Y0M1DT2H30M45.123456S"),
        (lambda x: v.to_day_second(x, "string"), "1500000", "P0Y0M0DT0H0M1.5S"),
        (v.literal_micros, "TO_TIMESTAMP('2024-01-15 10:30:45.123456')", 1705314645123456),
        (v.literal_micros, "to_timestamp('2024-01-15 10:30:45')", 1705314645000000),
        (v.literal_micros, "TO_DATE('2024-01-15 10:30:45', 'YYYY-MM-DD HH24:MI:SS')", 1705314645000000),
        (v.literal_micros, "TO_TIMESTAMP('15-JAN-24 10.30.45.5 AM')", 1705314645500000),
        (v.literal_micros, "TO_TIMESTAMP('15-JAN-24 10.30.45 PM')", 1705357845000000),
        (v.literal_micros, "1705314645123456", 1705314645123456),
        (v.literal_micros, "TO_SOMETHING('x')", None),
        (v.to_zoned_text, "TO_TIMESTAMP_TZ('2024-01-15 10:30:45.12 +08:00')", "2024-01-15T10:30:45.120000+08:00"),
        (lambda x: v.to_zoned_text(x, 0), "TO_TIMESTAMP_TZ('2024-01-15 10:30:45.12 +00:00')", "2024-01-15T10:30:45Z"),
        (v.to_boolean, "0", False),
        (v.to_boolean, "1", True),
        (v.to_boolean, "256", False),
        (v.to_tinyint, "42", 42),
        (v.to_tinyint, "true", 1),
        (v.to_tinyint, "false", 0),
        (v.to_tinyint, "300", None),
        (v.to_float, "3.14", pytest.approx(3.14, rel=1e-6)),
        (v.to_double, "3.14159", 3.14159),
        (v.to_duration, "-1:30:00", -5400000000),
        (v.to_duration, "'2024-01-01 01:00:00.5'", 3600500000),
        (v.to_duration, "1:30", 5400000000),
        (lambda x: v.to_bits(x, 1), "1", True),
        (lambda x: v.to_bits(x, 12), "000100000001", bytearray([1, 1])),
        (lambda x: v.to_string(x, False), "EMPTY_CLOB()", ""),
        (lambda x: v.to_string(x, True), "", None),
        (lambda x: v.to_binary(x, False, "hex"), "EMPTY_BLOB()", ""),
        (lambda x: v.to_binary(x, True, "base64"), "0102", "AQI="),
        (lambda x: scnf.instance_number(x), "AAAAAAA=", 0),
        (lambda x: scnf.instance_number(x), "127", 127),
        (lambda x: scnf.commit_entry(x)["redo_thread"], "100", 1),
        (lambda x: scnf.commit_entry(x)["tx_ids"], "500:2:tx1-tx2", ["tx1", "tx2"]),
        (lambda x: scnf.commit_entry(x)["tx_ids"], "500:2:", []),
        (lambda x: scnf.commit_entry(x)["redo_thread"], "500:unused:unused:3", 3),
        (scnf.commit_entry, "100:2", None),
        (scnf.commit_entry, "", None),
        (scnf.pending_map, "tx1:100,,tx2:200", {"tx1": 100, "tx2": 200}),
    ],
)
def test_example(spark, expr, text, want):
    assert one(spark, expr, text) == want


def test_decimal_scale(spark):
    assert str(one(spark, lambda x: v.to_decimal(x, 10, 4), "4.44")) == "4.4400"
    assert one(spark, lambda x: v.to_decimal(x, 10, 2), "4.444") is None
    assert one(spark, lambda x: v.to_decimal(x, 10, -2), "1250") is None
    assert one(spark, lambda x: v.to_decimal(x, 10, -2), "1200") == 1200
    row = one(spark, v.to_variable_scale, "123.45")
    assert (row["scale"], row["value"]) == (2, "123.45")


def test_scn_compare_and_arithmetic(spark):
    rows = spark.createDataFrame([(None, None), (None, 5), (5, None), (7, 5), (5, 7), (5, 5)], "a long, b long")
    a, b = F.col("a"), F.col("b")
    got = rows.select(scnf.scn_add(a, b).cast("long"), scnf.scn_sub(a, b).cast("long"), scnf.scn_cmp(a, b)).collect()
    assert [tuple(r) for r in got] == [(None, None, 0), (5, -5, -1), (5, 5, 1), (12, 2, 1), (12, -2, -1), (10, 0, 0)]


def test_failure_policies(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "n string")
    spec = [ColumnSpec("n", "INTEGER")]
    warn = typed.typed_projection(df, spec, Options(on_failure="warn")).collect()
    assert [(r["n"], r["failed"]) for r in warn] == [(1, []), (None, ["n"]), (None, [])]
    assert "failed" not in typed.typed_projection(df, spec, Options(on_failure="skip")).columns
    with pytest.raises(Exception, match="cannot convert n"):
        typed.typed_projection(df, spec, Options(on_failure="fail")).collect()


def test_placeholder_passes_but_not_for_json(spark):
    df = spark.createDataFrame([("__value_unavailable", "__value_unavailable")], "c string, j string")
    row = typed.typed_projection(df, [ColumnSpec("c", "CLOB"), ColumnSpec("j", "JSON")], Options(on_failure="fail")).first()
    assert (row["c"], row["j"]) == ("__value_unavailable", None)


def test_spec_types(spark):
    df = spark.createDataFrame([("1",)], "n string")
    kind = lambda p, s, **o: typed.typed_projection(df, [ColumnSpec("n", "NUMERIC", p, s)], Options(on_failure="skip", **o)).dtypes[0][1]
    assert [kind(2, 0), kind(4, 0), kind(9, 0), kind(18, 0), kind(19, 0)] == ["tinyint", "smallint", "int", "bigint", "decimal(19,0)"]
    assert kind(10, -2) == "bigint" and kind(12, 4) == "decimal(12,4)"
    assert kind(10, 0, decimal_mode="double", legacy_decimal=False) == "double"
    assert kind(10, 0, decimal_mode="double") == "bigint"


def test_ddl_shapes(spark):
    ddl = [
        (1, "ALTER TABLE T CHANGE COLUMN A B NUMBER(5) NOT NULL"),
        (2, "ALTER TABLE T ADD (C INT, D VARCHAR(10) DEFAULT 'a,b')"),
        (3, "ALTER TABLE T DROP (C, \"d\")"),
        (4, "ALTER TABLE T ADD PARTITION P1 VALUES LESS THAN (5)"),
        (5, "CREATE TABLE T2 AS SELECT * FROM T"),
        (6, "ALTER TABLE T ADD PRIMARY KEY (A, B)"),
        (7, "ALTER TABLE T ADD I INTERVAL DAY(3) TO SECOND(9)"),
        (8, "nonsense"),
    ]
    df = spark.createDataFrame(ddl, "scn long, ddl_text string").withColumn("schema_name", F.lit("S"))
    got = {}
    for r in history.column_changes(df).orderBy("scn", "seq").collect():
        got.setdefault(r["scn"], []).append((r["action"], r["column_name"], r["new_name"] or r["type_text"], r["key_columns"]))
    assert got == {
        1: [("rename", "A", "B", None), ("modify", "B", "NUMBER(5)", None)],
        2: [("add", "C", "INT", None), ("add", "D", "VARCHAR(10)", None)],
        3: [("drop", "C", None, None), ("drop", "d", None, None)],
        6: [("set-pk", None, None, ["A", "B"])],
        7: [("add", "I", "INTERVAL DAY(3) TO SECOND(9)", None)],
    }
    _, bad = history.ddl_quarantine(df)
    assert sorted(r["scn"] for r in bad.collect()) == [5, 8]
    good, _ = history.ddl_quarantine(df, "fail")
    with pytest.raises(Exception, match="statement not understood"):
        good.collect()


@pytest.mark.parametrize("small", [history.SMALL, 0])
def test_renames_chain_and_swap(spark, monkeypatch, small):
    # 0: the way taken for logs that were counted as large
    monkeypatch.setattr(history, "SMALL", small)
    ddl = [
        "CREATE TABLE A (X INT, Y INT)", "ALTER TABLE A RENAME TO B", "ALTER TABLE B RENAME COLUMN X TO Z", "CREATE TABLE A (Q INT)",
        "ALTER TABLE NOPE RENAME TO M", "ALTER TABLE M ADD W INT", "ALTER TABLE B RENAME TO C", "ALTER TABLE C RENAME COLUMN Y TO X",
        "ALTER TABLE C DROP COLUMN Z", "ALTER TABLE C ADD Z DATE",
    ]
    df = spark.createDataFrame([(i, "S", t) for i, t in enumerate(ddl)], "scn long, schema_name string, ddl_text string")
    rows = history.fold_schema(history.schema_timeline(history.column_changes(df))).collect()
    assert sorted((r["table_name"], r["position"], r["column_name"], r["type_text"]) for r in rows) == [
        ("A", 1, "Q", "INT"), ("C", 1, "X", "INT"), ("C", 2, "Z", "DATE"),
    ]
