"""Conversions, value by value."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from tagloom.functions import convert as cv, identity

GUID = "01234567-89ab-cdef-0123-456789abcdef"
HEX = GUID.replace("-", "")

CASES = {
    cv.integer: [
        (None, None), ("", None), (" ", None), ("12", 12), (" 12\n", 12), ("\u00a05\u2003", 5),
        ("+5", 5), ("-5", -5), ("007", 7), ("12.7", None), ("1_000", None), ("1e2", None),
        ("2147483647", 2147483647), ("2147483648", None), ("abc", None), ("1 2", None),
    ],
    cv.integer_or_zero: [(None, 0), ("", 0), (" \t", 0), (" 3 ", 3), ("x", None)],
    cv.optional_integer: [(None, None), (" ", None), (" 3 ", 3), ("x", None)],
    cv.long_integer: [("3000000000", 3000000000), ("9223372036854775808", None), ("", None)],
    cv.boolean: [
        *[(w, True) for w in ("true", "1", "yes", "y", "t", " TRUE ", "Yes\n")],
        *[(w, False) for w in (None, "", "false", "0", "on", "no", "2", "truex")],
    ],
    cv.strict_boolean: [("true", True), ("True", False), (" true", False), (None, False), ("1", False)],
    cv.folded_boolean: [(" True ", True), ("1", False), ("", False), (None, None)],
    cv.text: [(None, None), ("", ""), (" a b\t\n", "a b"), ("\u3000x\u00a0", "x")],
    cv.text_or_empty: [(None, ""), ("", ""), (" a ", " a ")],
    cv.optional_text: [(None, None), ("", None), (" ", ""), (" a ", "a")],
    cv.optional_trimmed: [(None, None), ("", None), (" ", None), (" a ", "a")],
    cv.uuid: [
        (None, None), (" ", None), (GUID, GUID), (GUID.upper(), GUID), (HEX, GUID),
        ("{" + GUID + "}", GUID), ("{" + HEX + "}", GUID), (f" {GUID}\n", GUID),
        ("-" + GUID, GUID), (GUID + "-", GUID), (HEX[:3] + "-" + HEX[3:], GUID),
        ("{" + GUID, None), (GUID + "}", None), (HEX[:-1], None), (HEX + "0", None),
        ("nope", None), ("{}", None), ("urn:uuid:" + GUID, None), (GUID.replace("a", "g"), None),
    ],
    cv.floating: [
        (None, None), ("", None), ("1.5", 1.5), (" -2e3 ", -2000.0), (".5", 0.5), ("5.", 5.0),
        ("inf", float("inf")), ("-Infinity", float("-inf")), ("1.0d", None), ("0x1p3", None),
        ("1,5", None), ("e5", None),
    ],
    cv.date_time: [
        (None, None), ("", None), ("2024-01-02 03:04", datetime(2024, 1, 2, 3, 4)),
        ("2024-1-2 3:4", datetime(2024, 1, 2, 3, 4)), ("2024-1-2  3:4", datetime(2024, 1, 2, 3, 4)),
        ("2024-02-29 23:59", datetime(2024, 2, 29, 23, 59)), ("2023-02-29 00:00", None),
        ("2024-13-01 00:00", None), ("2024-01-01 24:00", None), ("24-01-01 00:00", None),
        ("2024-01-01", None), ("2024-01-01 00:00:00", None), (" 2024-01-01 00:00", None),
        ("2024-03-31 02:30", datetime(2024, 3, 31, 2, 30)),
    ],
}


@pytest.mark.parametrize("function", CASES, ids=lambda f: f.__name__)
def test_conversion(spark, function):
    given = [(i, text) for i, (text, _) in enumerate(CASES[function])]
    frame = spark.createDataFrame(given, "i int, v string")
    found = frame.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()
    assert [(t, r.r) for (t, _), r in zip(CASES[function], found)] == CASES[function]


def test_uuid_forms_agree_with_duckdb(spark):
    import duckdb

    texts = [t.strip() for t, _ in CASES[cv.uuid] if t and t.strip()]
    frame = spark.createDataFrame([(t,) for t in texts], "v string")
    ours = [r.r for r in frame.select(cv.uuid(F.col("v")).alias("r")).collect()]
    sql = "SELECT CAST(TRY_CAST(? AS UUID) AS VARCHAR)"
    assert ours == [duckdb.execute(sql, [t]).fetchone()[0] for t in texts]


def test_by_type(spark):
    frame = spark.createDataFrame([(None, "1", "2024-1-2 3:4")], "n string, v string, t string")
    types = (
        T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType(),
        T.TimestampNTZType(), T.TimestampType(), T.DateType(),
    )
    nulls = frame.select(*[cv.convert(F.col("n"), t).alias(str(i)) for i, t in enumerate(types)])
    assert set(nulls.first()) == {None}
    assert [f.dataType for f in nulls.schema] == list(types)
    found = frame.select(
        cv.convert(F.col("v"), T.DoubleType()), cv.convert(F.col("t"), T.TimestampNTZType())
    ).first()
    assert tuple(found) == (1.0, datetime(2024, 1, 2, 3, 4))


def test_identity(spark):
    objects = spark.createDataFrame(
        [(1, 2, "a", True, GUID), (1, 3, "b", False, None), (1, 4, "c", True, "")],
        "class_id int, object_id int, name string, show boolean, guid string",
    )
    found = objects.select(
        identity.object_identifier(), identity.object_display(), identity.is_enabled()
    ).collect()
    assert [r[0] for r in found] == [GUID, "1:3", "1:4"]
    assert found[0][1] == "TObject(id=2, class_id=1, name='a')"
    assert [r[2] for r in found] == [True, False, True]
    properties = spark.createDataFrame(
        [(1, 2, 3, "p", True, False), (1, 2, None, "q", False, True)],
        "property_id int, collection_id int, enum_id int, name string, is_period boolean, "
        "is_summary boolean",
    )
    found = properties.select(
        identity.property_identifier(),
        identity.property_display(),
        identity.has_enum(),
        identity.is_time_varying(),
        identity.is_aggregable(),
    ).collect()
    assert [tuple(r) for r in found] == [
        ("1:2:3", "TProperty(id=1, name='p', collection_id=2)", True, True, False),
        ("1:2", "TProperty(id=1, name='q', collection_id=2)", False, False, True),
    ]
