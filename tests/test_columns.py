"""Column choice, types, windows, literals, encryption."""

from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

import rowmend as rm
from conftest import rows
from rowmend.functions.columns import ordered_unique, split_names
from rowmend.functions.literals import sql_literal
from rowmend.functions.times import format_range, in_window, parse_range, range_end, range_start

SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("age", T.IntegerType()),
        T.StructField("update_time", T.TimestampNTZType()),
        T.StructField("salary", T.DoubleType()),
        T.StructField("tags", T.ArrayType(T.StringType())),
    ]
)


def test_roles():
    roles = rm.compare_columns(SCHEMA, ["id"], "update_time")
    assert (roles.keys, roles.update, roles.extra) == (("id",), "update_time", ("age", "salary"))
    assert roles.all == ["id", "update_time", "age", "salary"]
    assert rm.compare_columns(SCHEMA, ["id"], include_strings=True).extra == ("name", "age", "update_time", "salary")
    assert rm.compare_columns(SCHEMA, ["id"], "update_time", include_extra=False).all == ["id", "update_time"]


def test_sensitive_columns_leave():
    roles = rm.compare_columns(SCHEMA, ["id"], "update_time", " salary , update_time,, ")
    assert roles.all == ["id", "age"]
    with pytest.raises(ValueError, match="sensitive"):
        rm.compare_columns(SCHEMA, ["id"], sensitive="id")


def test_no_key():
    with pytest.raises(ValueError, match="primary key"):
        rm.compare_columns(SCHEMA, [])


def test_name_lists():
    assert ordered_unique(["b", "a", "b"]) == ["b", "a"]
    assert split_names(None) == []


def test_common_columns(spark):
    a, b = spark.createDataFrame([], "id int, x int"), spark.createDataFrame([], "y int, id int")
    assert rm.common_columns(a, b, ["id"]) == ["id"]
    with pytest.raises(ValueError, match="in common"):
        rm.common_columns(a, b.drop("id"))


def test_fold_names(spark):
    assert rm.fold_names(spark.createDataFrame([], "ID int, Name string")).columns == ["id", "name"]
    with pytest.raises(ValueError, match="case"):
        rm.fold_names(spark.createDataFrame([], T.StructType().add("a", T.IntegerType()).add("A", T.IntegerType())))


@pytest.mark.parametrize(
    "a, b, goal",
    [
        ("int", "double", "double"),
        ("tinyint", "int", "bigint"),
        ("float", "decimal(10,2)", "double"),
        ("int", "decimal(10,2)", "decimal(12,2)"),
        ("decimal(38,0)", "decimal(38,10)", "double"),
        ("timestamp_ntz", "string", "timestamp_ntz"),
        ("date", "timestamp", "timestamp"),
        ("date", "date", "date"),
        ("string", "int", "string"),
        ("boolean", "int", "string"),
    ],
)
def test_unified_type(spark, a, b, goal):
    kind = {x: spark.createDataFrame([], f"v {x}").schema["v"].dataType for x in (a, b, goal)}
    assert rm.unified_type(kind[a], kind[b]) == kind[goal]
    assert rm.unified_type(kind[b], kind[a]) == kind[goal]


def test_unreadable_time(spark):
    a = spark.createDataFrame([("soon",)], "at string")
    b = spark.createDataFrame([(datetime(2026, 1, 1),)], "at timestamp_ntz")
    assert rows(rm.unify_types(a, b, unparseable="null")[0]) == [(None,)]
    with pytest.raises(PySparkException):
        rm.unify_types(a, b)[0].collect()


def test_range_text(spark):
    start, end = datetime(2026, 1, 1, 2, 3, 4), datetime(2026, 1, 8)
    text = format_range(start, end)
    assert text == "[2026-01-01 02:03:04,2026-01-08 00:00:00)"
    assert parse_range(text) == (start, end)
    for wrong in ("", "[2026-01-01,2026-01-08)", "2026-01-01 00:00:00,2026-01-08 00:00:00"):
        with pytest.raises(ValueError, match="check range"):
            parse_range(wrong)
    df = spark.createDataFrame([(text,), ("none",)], "r string")
    got = [tuple(r) for r in df.select(range_start(F.col("r")), range_end(F.col("r"))).collect()]
    assert got == [(start, end), (None, None)]


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "string"])
def test_window_is_half_open(spark, kind):
    texts = ["2026-01-01 00:00:00", "2026-01-02 00:00:00", "2026-01-03 00:00:00", "2026-01-04 00:00:00"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, at string")
    df = df.select("i", F.col("at").cast(kind).alias("at"))
    kept = df.where(in_window("at", df.schema["at"].dataType, datetime(2026, 1, 2), datetime(2026, 1, 4)))
    assert rows(kept.select("i")) == [(1,), (2,)]


def test_date_window_with_hours(spark):
    df = spark.createDataFrame([(date(2026, 1, 1),), (date(2026, 1, 2),), (date(2026, 1, 3),)], "at date")
    inside = in_window("at", T.DateType(), datetime(2026, 1, 1, 12), datetime(2026, 1, 2, 12))
    assert rows(df.where(inside)) == [(date(2026, 1, 2),)]


def test_incremental_filter(spark):
    df = spark.createDataFrame([(datetime(2026, 1, 1),), (datetime(2026, 1, 2),)], "at timestamp_ntz")
    assert rm.incremental_filter(df, "at", 1, datetime(2026, 1, 2)).count() == 1
    assert rm.incremental_filter(df, None, 1, datetime(2026, 1, 2)) is df
    assert rm.incremental_filter(df, "at", None, datetime(2026, 1, 2)) is df


def test_literals(spark):
    df = spark.createDataFrame(
        [("test'value", 123, 45.67, datetime(2026, 2, 26, 12, 30, 45, 500000), date(2026, 2, 26), None)],
        "a string, b int, c double, d timestamp_ntz, e date, f string",
    )
    got = df.select(*[sql_literal(F.col(f.name), f.dataType) for f in df.schema.fields]).first()
    assert tuple(got) == ("'test''value'", "123", "45.67", "'2026-02-26 12:30:45.5'", "'2026-02-26'", "NULL")


def test_encryption(spark):
    df = spark.createDataFrame([("secret",), ("",), (None,), ("päss wörd",)], "p string")
    key = F.lit("0123456789abcdef")
    sealed = df.select("p", rm.encrypt_column(F.col("p"), key).alias("s"))
    opened = sealed.select("p", rm.decrypt_column(F.col("s"), key).alias("o"))
    assert all(r["p"] == r["o"] for r in opened.collect())
    again = [r["s"] for r in sealed.where("p = 'secret'").union(sealed.where("p = 'secret'")).collect()]
    assert again[0] != again[1]


def test_stored_layout_is_iv_then_ciphertext(spark):
    """A value sealed elsewhere with AES-CBC: base64(iv + ciphertext), PKCS padding."""
    sealed = F.base64(
        F.aes_encrypt(F.lit("secret"), F.lit("0123456789abcdef"), F.lit("CBC"), F.lit("PKCS"), F.lit(bytes(16)))
    )
    row = spark.range(1).select(sealed.alias("s"), rm.decrypt_column(sealed, F.lit("0123456789abcdef")).alias("o")).first()
    assert row["o"] == "secret"
    import base64

    assert base64.b64decode(row["s"])[:16] == bytes(16)
