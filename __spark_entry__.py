"""

The queries run over XML and ZIP documents that Spark writes from the Parquet
test tables (`tagloom_fixtures.py`), so what they read grows with those tables.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tagloom_fixtures as fx  # noqa: E402
from tagloom import (  # noqa: E402
    Field,
    IngestError,
    Registry,
    Source,
    TableSpec,
    default_registry,
    ingest,
    ingest_stream,
    profile,
    read_table,
)
from tagloom.functions import convert as cv, identity  # noqa: E402
from tagloom.plans.events import read_events  # noqa: E402
from tagloom.plans.profile import runs_of_unknown_tables, totals, unknown_tables  # noqa: E402
from tagloom.spec import BIGINT, INTEGER, VARCHAR  # noqa: E402

try:
    import corpus_pipeline  # noqa: E402
    from tagloom.llm import queries as llm_queries  # noqa: E402
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tagloom.llm"):
        raise
    llm_queries = None

ENTRY_DIR = "/root/testdata/sf0.001"
MEMBER = "SolutionDataset.xml"
Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Typed objects with their identifiers, read from XML."""
    return object_identifier(spark, ENTRY_DIR)


# --- documents and databases -------------------------------------------------


def _text(spark: SparkSession, sf_dir: str, make: Callable, prefix: str = "") -> Source:
    return Source(fx.documents(spark, sf_dir, make, prefix))


def _zip(spark: SparkSession, sf_dir: str, make: Callable) -> Source:
    return Source(fx.archives(spark, sf_dir, make, MEMBER), "zip", MEMBER)


def _database(spark: SparkSession) -> str:
    name = f"tagloom_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fx.fresh_folder(spark, 'db')}'")
    return name


def _loaded(spark: SparkSession, sf_dir: str, make: Callable, **options) -> str:
    database = _database(spark)
    ingest(spark, _text(spark, sf_dir, make), database, **options)
    return database


# --- ingest ------------------------------------------------------------------


def _read(source: Callable, make: Callable, name: str) -> Query:
    return lambda spark, sf_dir: read_table(spark, source(spark, sf_dir, make), name)


def _load(make: Callable, name: str) -> Query:
    return lambda spark, sf_dir: spark.table(f"{_loaded(spark, sf_dir, make)}.{name}")


def ingest_stream_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, checkpoint = _database(spark), fx.fresh_folder(spark, "checkpoint")
    folder = fx.documents(spark, sf_dir, fx.everything)
    ingest_stream(
        spark, folder, database, checkpoint, max_files_per_trigger=3
    ).awaitTermination()
    return spark.table(f"{database}.t_key").drop("stream_id", "batch_id")


def rows_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, _text(spark, sf_dir, fx.everything), _database(spark))


def rows_by_table_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, _zip(spark, sf_dir, fx.everything), _database(spark))


def load_replaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load with overwrite over a load of other rows."""
    database = _loaded(spark, sf_dir, fx.bad_objects, mode="quarantine")
    ingest(spark, _text(spark, sf_dir, fx.objects), database, overwrite=True)
    return spark.table(f"{database}.t_object")


def failed_load_keeps_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refused load over a good one leaves the good one."""
    database = _loaded(spark, sf_dir, fx.objects)
    try:
        ingest(spark, _text(spark, sf_dir, fx.bad_objects), database, overwrite=True)
    except IngestError:
        return spark.table(f"{database}.t_object")
    raise AssertionError("a load with violations was accepted")


def tables_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per created table; tables without rows in the input exist, empty."""
    database = _loaded(spark, sf_dir, fx.objects)
    counts = [
        spark.table(f"{database}.{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("rows")
        )
        for name in default_registry().names()
    ]
    return counts[0].unionAll(counts[1]).unionAll(counts[2])


def table_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared columns of every known table, beside the rows the documents hold of it."""
    rows = (
        profile(spark, _text(spark, sf_dir, fx.everything))
        .filter("known")
        .groupBy(F.col("tag").alias("table_name"))
        .agg(F.sum("rows").alias("rows"))
    )
    return default_registry().listing(spark).join(rows, "table_name", "left")


def custom_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A further table with a renamed column, a default and a conversion of its own."""
    spec = TableSpec(
        "t_band",
        (
            Field("band_id", INTEGER, column="band"),
            Field("band_id", INTEGER, column="doubled", convert=lambda v: v.try_cast("int") * 2),
            Field("grade", INTEGER, required=False, default=7),
        ),
    )
    rows = read_table(spark, _text(spark, sf_dir, fx.everything), "t_band", Registry.of(spec))
    return rows.select("band", "grade").unionAll(
        rows.select(F.col("doubled").alias("band"), F.lit(None).cast("int").alias("grade"))
    )


def healed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects from documents that have to be read as a whole, next to some that have not."""
    return read_table(spark, Source(fx.odd_documents(spark, sf_dir)), "t_object")


def zip_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects from archives of several documents each, chosen by a pattern."""
    folder = fx.shared_archives(spark, sf_dir, fx.objects)
    return read_table(spark, Source(folder, "zip", "part-*.xml"), "t_object")


def document_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is said of archives that cannot be read, each in its way, and the rows of the others."""
    source, database = Source(fx.faulty_archives(spark, sf_dir, MEMBER), "zip", MEMBER), _database(spark)
    ingest(spark, source, database, mode="quarantine")
    events = read_events(spark, database)
    faults = events.filter("level = 'ERROR'").groupBy("rule").agg(F.count_distinct("source").alias("n"))
    loaded = events.filter("rule = 'rows_loaded'").groupBy("rule").agg(F.sum("occurrences").alias("n"))
    return faults.unionAll(loaded)


def malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows whose tags do not match."""
    database = _loaded(spark, sf_dir, fx.malformed_objects, mode="quarantine")
    object_id = F.regexp_extract("row_xml", r"<object_id>(\d+)<", 1).cast("bigint")
    return spark.table(f"{database}.t_object__rejects").select(
        object_id.alias("object_id"), F.explode("violations.rule").alias("rule")
    )


def fault_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each rejected row begins at the byte and the line that its reject names.

    The documents are read in pieces, each once, with the rejects that begin in it.
    """
    folder, database = _text(spark, sf_dir, fx.malformed_objects), _database(spark)
    ingest(spark, folder, database, mode="quarantine")
    found = fx.rows_at(spark, folder.paths, spark.table(f"{database}.t_object__rejects"))
    row_end = F.substring_index(F.col("row_xml"), "</t_object>", 1)
    return found.select(
        F.regexp_extract("row_xml", r"<object_id>(\d+)<", 1).cast("bigint").alias("object_id"),
        F.col("there").startswith(row_end).alias("at_byte"),
        (F.col("line_there") == F.col("line")).alias("at_line"),
    )


def unknown_table_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs and rows of tables nobody knows, over documents that alternate between two of them."""
    found = runs_of_unknown_tables(spark, Source(fx.alternating_documents(spark, sf_dir)))
    return found.groupBy("tag").agg(F.sum("runs").alias("runs"), F.sum("rows").alias("rows"))


def damaged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of documents without an end: refused in strict mode, loaded and reported otherwise."""
    source, database = Source(fx.unfinished_documents(spark, sf_dir)), _database(spark)
    try:
        ingest(spark, source, database)
    except IngestError:
        ingest(spark, source, database, mode="quarantine")
        return spark.table(f"{database}.t_object")
    raise AssertionError("documents without an end were accepted")


def spelled_children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables that spell a child differently, and rows that use either spelling."""
    specs = [
        TableSpec(name, (Field("key", BIGINT), Field("guid", VARCHAR, required=False, child=child)))
        for name, child in (("t_a", "GUID"), ("t_b", "guid"))
    ]
    database = _loaded(spark, sf_dir, fx.spelled_rows, registry=Registry.of(*specs))
    rows = [spark.table(f"{database}.{s.name}").select(F.lit(s.name).alias("table_name"), "*") for s in specs]
    return rows[0].unionAll(rows[1])


def two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one database keep each other's rows."""
    database = _database(spark)
    for make in (fx.objects, fx.bad_objects):
        folder, checkpoint = fx.documents(spark, sf_dir, make), fx.fresh_folder(spark, "checkpoint")
        ingest_stream(spark, folder, database, checkpoint).awaitTermination()
    return spark.table(f"{database}.t_object").drop("stream_id", "batch_id")


# --- profile -----------------------------------------------------------------


def _profile(spark: SparkSession, sf_dir: str, source: Callable = _text) -> DataFrame:
    return profile(spark, source(spark, sf_dir, fx.everything))


def element_profile(spark: SparkSession, sf_dir: str, source: Callable = _text) -> DataFrame:
    return (
        _profile(spark, sf_dir, source)
        .groupBy(F.coalesce("tag", F.lit("(outside)")).alias("tag"))
        .agg(F.sum("rows").alias("rows"), F.sum("elements").alias("elements"))
    )


def element_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(_profile(spark, sf_dir))


def unknown_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        unknown_tables(_profile(spark, sf_dir)).groupBy("tag").agg(F.sum("rows").alias("rows"))
    )


# --- quality -----------------------------------------------------------------


def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per violated rule of every rejected row."""
    database = _loaded(spark, sf_dir, fx.bad_objects, mode="quarantine")
    object_id = F.regexp_extract("row_xml", r"<object_id>(\d+)<", 1).cast("bigint")
    return (
        spark.table(f"{database}.t_object__rejects")
        .select(object_id.alias("object_id"), F.explode("violations").alias("v"))
        .select(
            "object_id",
            F.col("v.rule").alias("rule"),
            F.col("v.column").alias("column_name"),
            F.col("v.value").alias("value"),
        )
    )


def quarantine_keeps_good_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = _loaded(spark, sf_dir, fx.bad_objects, mode="quarantine")
    return spark.table(f"{database}.t_object").select("object_id", "class_id", "name")


def ingest_event_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of two loads: one with unknown tables, one with violations."""
    database = _loaded(spark, sf_dir, fx.everything)
    ingest(
        spark,
        _text(spark, sf_dir, fx.bad_objects),
        database,
        mode="quarantine",
        overwrite=True,
    )
    return (
        read_events(spark, database)
        .groupBy("level", "table_name", "rule", "column_name")
        .agg(F.sum("occurrences").alias("occurrences"))
    )


def uuid_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GUIDs in several notations; rows with a malformed one are rejected."""
    database = _loaded(spark, sf_dir, fx.odd_guid_objects, mode="quarantine")
    good = spark.table(f"{database}.t_object").select(
        F.col("object_id").cast("bigint").alias("object_id"), "guid", F.lit(None).alias("rule")
    )
    bad = spark.table(f"{database}.t_object__rejects").select(
        F.regexp_extract("row_xml", r"<object_id>(\d+)<", 1).cast("bigint").alias("object_id"),
        F.lit(None).cast("string").alias("guid"),
        F.col("violations")[0]["rule"].alias("rule"),
    )
    return good.unionAll(bad)


# --- functions ---------------------------------------------------------------


def object_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    objects = read_table(spark, _text(spark, sf_dir, fx.objects), "t_object")
    return objects.select(
        "object_id",
        identity.object_identifier().alias("identifier"),
        identity.object_display().alias("display"),
        identity.is_enabled().alias("is_enabled"),
    )


def property_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, _text(spark, sf_dir, fx.properties), "t_property")
    return rows.select(
        "property_id",
        identity.property_identifier().alias("identifier"),
        identity.property_display().alias("display"),
        identity.has_enum().alias("has_enum"),
        identity.is_time_varying().alias("is_time_varying"),
        identity.is_aggregable().alias("is_aggregable"),
    )


def varying_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, _text(spark, sf_dir, fx.properties), "t_property")
    wanted = identity.has_enum() & identity.is_time_varying() & ~identity.is_aggregable()
    return rows.filter(wanted).select("property_id", "collection_id", "enum_id")


def _number_text(e: Column) -> Column:
    text = e.cast("string")
    return (
        F.when(e % 9 == 0, text)
        .when(e % 9 == 1, F.concat(F.lit(" \t"), text, F.lit("\n")))
        .when(e % 9 == 2, F.concat(F.lit("+"), text))
        .when(e % 9 == 3, F.concat(F.lit("-"), text))
        .when(e % 9 == 4, " ")
        .when(e % 9 == 5, F.concat(text, F.lit(".7")))
        .when(e % 9 == 6, F.concat(F.lit("n"), text))
        .when(e % 9 == 7, (F.lit(3000000000) + e).cast("string"))
    )


def _word_text(e: Column) -> Column:
    """NULL for the last remainder."""
    words = ("true", " TRUE ", "1", "yes", "Y", "t", "on", "no", "", "false")
    text = F.lit(None).cast("string")
    for i, word in enumerate(words):
        text = F.when(e % 11 == i, word).otherwise(text)
    return text


def _float_text(e: Column) -> Column:
    text = e.cast("string")
    return (
        F.when(e % 6 == 0, F.concat(text, F.lit(".5")))
        .when(e % 6 == 1, F.concat(F.lit(" "), text, F.lit(" ")))
        .when(e % 6 == 2, F.concat(F.lit("-"), text, F.lit("e2")))
        .when(e % 6 == 3, F.concat(text, F.lit("d")))
        .when(e % 6 == 4, "")
    )


def _time_text(e: Column) -> Column:
    day, minute = (e % 9 + 1).cast("string"), (e % 60).cast("string")
    return (
        F.when(e % 4 == 0, F.concat(F.lit("2024-1-"), day, F.lit(" 3:"), minute))
        .when(e % 4 == 1, F.concat(F.lit("2024-02-0"), day, F.lit("  13:"), minute))
        .when(e % 4 == 2, F.concat(F.lit("2024-13-"), day, F.lit(" 3:"), minute))
    )


def _guid_text(e: Column) -> Column:
    good = fx.guid(e)
    return (
        F.when(e % 6 == 0, good)
        .when(e % 6 == 1, F.concat(F.lit(" {"), F.upper(good), F.lit("} ")))
        .when(e % 6 == 2, F.replace(good, F.lit("-"), F.lit("")))
        .when(e % 6 == 3, F.concat(good, F.lit("0")))
        .when(e % 6 == 4, " ")
    )


def _convert(text: Callable, *functions: Callable) -> Query:
    """Convert texts derived from the event id; one column per function."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        e = F.col("event_id")
        texts = fx.table(spark, sf_dir, "events").select("event_id", text(e).alias("text"))
        return texts.select(
            "event_id", *[f(F.col("text")).alias(f.__name__) for f in functions]
        )

    return query


def convert_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return fx.table(spark, sf_dir, "events").select(
        "event_id",
        cv.convert(_number_text(e), T.IntegerType()).alias("int_value"),
        cv.convert(_number_text(e), T.LongType()).alias("long_value"),
        cv.convert(_float_text(e), T.DoubleType()).alias("double_value"),
        cv.convert(_word_text(e), T.BooleanType()).alias("boolean_value"),
        cv.convert(_word_text(e), T.StringType()).alias("string_value"),
        F.date_format(cv.convert(_time_text(e), T.TimestampNTZType()), "yyyy-MM-dd HH:mm").alias(
            "time_value"
        ),
    )


def convert_date_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = cv.date_time(_time_text(F.col("event_id")))
    return fx.table(spark, sf_dir, "events").select(
        "event_id", F.date_format(value, "yyyy-MM-dd HH:mm").alias("date_time")
    )


def queries() -> dict[str, Query]:
    tables = (("object", fx.objects), ("property", fx.properties), ("key", fx.keys))
    found: dict[str, Query] = {}
    if llm_queries:
        found |= llm_queries.queries() | {"pipeline": corpus_pipeline.run}
    for name, make in tables:
        found[f"ingest_{name}"] = _read(_text, make, f"t_{name}")
        found[f"ingest_{name}_mixed"] = _read(_text, fx.everything, f"t_{name}")
        found[f"ingest_{name}_zip"] = _read(_zip, fx.everything, f"t_{name}")
        found[f"ingest_{name}_prefixed"] = _read(
            partial(_text, prefix="s"), make, f"t_{name}"
        )
        found[f"load_{name}"] = _load(fx.everything, f"t_{name}")
    return found | {
        "ingest_stream": ingest_stream_key,
        "rows_by_table": rows_by_table,
        "rows_by_table_zip": rows_by_table_zip,
        "load_replaces": load_replaces,
        "failed_load_keeps_tables": failed_load_keeps_tables,
        "tables_created": tables_created,
        "table_listing": table_listing,
        "custom_table": custom_table,
        "element_profile": element_profile,
        "element_profile_zip": partial(element_profile, source=_zip),
        "healed_documents": healed_documents,
        "zip_members": zip_members,
        "fault_places": fault_places,
        "document_statuses": document_statuses,
        "unknown_table_runs": unknown_table_runs,
        "malformed_rows": malformed_rows,
        "damaged_documents": damaged_documents,
        "spelled_children": spelled_children,
        "two_streams": two_streams,
        "element_totals": element_totals,
        "unknown_tables": unknown_table_rows,
        "rejects": rejects,
        "quarantine_keeps_good_rows": quarantine_keeps_good_rows,
        "ingest_events": ingest_event_counts,
        "uuid_check": uuid_check,
        "object_identifier": object_identifier,
        "property_identifier": property_identifier,
        "varying_properties": varying_properties,
        "convert_integer": _convert(_number_text, cv.integer),
        "convert_optional_integer": _convert(_number_text, cv.optional_integer),
        "convert_integer_or_zero": _convert(_number_text, cv.integer_or_zero),
        "convert_boolean": _convert(_word_text, cv.boolean),
        "convert_strict_boolean": _convert(_word_text, cv.strict_boolean),
        "convert_folded_boolean": _convert(_word_text, cv.folded_boolean),
        "convert_text": _convert(_word_text, cv.text, cv.text_or_empty),
        "convert_optional_text": _convert(_number_text, cv.optional_text, cv.optional_trimmed),
        "convert_uuid": _convert(_guid_text, cv.uuid),
        "convert_floating": _convert(_float_text, cv.floating),
        "convert_date_time": convert_date_time,
        "convert_by_type": convert_by_type,
    }


# --- the same in SQL ---------------------------------------------------------

_GUID = (
    "substr(md5({k}), 1, 8) || '-' || substr(md5({k}), 9, 4) || '-' || substr(md5({k}), 13, 4) "
    "|| '-' || substr(md5({k}), 17, 4) || '-' || substr(md5({k}), 21, 12)"
)
_PART_GUID = _GUID.format(k="CAST(p_partkey AS VARCHAR)")
_EVENT_GUID = _GUID.format(k="CAST(event_id AS VARCHAR)")

_OBJECT = f"""
SELECT CAST(p_size AS INTEGER) AS class_id, p_name AS name,
       CAST(p_size % 7 AS INTEGER) AS category_id, CAST(p_partkey % 100 AS INTEGER) AS "index",
       CAST(p_partkey AS INTEGER) AS object_id, p_partkey % 3 <> 2 AS "show",
       CASE WHEN p_partkey % 4 <> 0 THEN {_PART_GUID} END AS guid
FROM part"""
_PROPERTY = """
SELECT CAST(o_orderkey AS INTEGER) AS property_id, CAST(o_custkey AS INTEGER) AS collection_id,
       CASE WHEN o_orderkey % 5 > 1 THEN CAST(o_orderkey % 9 AS INTEGER) END AS enum_id,
       o_orderpriority AS name, o_orderstatus AS summary_name,
       CAST(o_custkey % 11 AS INTEGER) AS unit_id,
       CAST(o_custkey % 13 AS INTEGER) AS summary_unit_id,
       o_orderkey % 2 = 0 AS is_multi_band, o_orderkey % 3 = 0 AS is_period,
       o_orderkey % 4 = 0 AS is_summary, CAST(o_orderkey % 6 AS INTEGER) AS lang_id
FROM orders"""
_KEY = """
SELECT CAST(l_orderkey * 10 + l_linenumber AS INTEGER) AS key_id,
       CAST(l_suppkey AS INTEGER) AS membership_id, CAST(l_linenumber AS INTEGER) AS phase_id,
       CAST(l_partkey AS INTEGER) AS property_id,
       CAST(l_linenumber % 5 AS INTEGER) AS period_type_id
FROM lineitem"""
_ROWS_BY_TABLE = """
SELECT 't_object' AS table_name, count(*) AS "rows" FROM part
UNION ALL SELECT 't_property', count(*) FROM orders
UNION ALL SELECT 't_key', count(*) FROM lineitem
UNION ALL SELECT '(total)', (SELECT count(*) FROM part) + (SELECT count(*) FROM orders)
                            + (SELECT count(*) FROM lineitem)"""
# elements: the row itself and its children; an absent enum_id is no element
_ELEMENTS = f"""
SELECT 't_object' AS tag, count(*) AS "rows", CAST(8 * count(*) AS BIGINT) AS elements FROM part
UNION ALL SELECT 't_property', count(*),
       CAST(12 * count(*) - count(CASE WHEN o_orderkey % 5 = 0 THEN 1 END) AS BIGINT) FROM orders
UNION ALL SELECT 't_key', count(*), CAST(6 * count(*) AS BIGINT) FROM lineitem
UNION ALL SELECT 't_band', count(*), CAST(2 * count(*) AS BIGINT) FROM supplier
UNION ALL SELECT '(outside)', 0, {fx.FILES}"""
_BAD = "(" + " OR ".join(f"p_partkey % {n} = 0" for n in (10, 11, 13, 17)) + ")"
_INT = """CASE event_id % 9 WHEN 0 THEN event_id WHEN 1 THEN event_id WHEN 2 THEN event_id
          WHEN 3 THEN -event_id END"""
_LISTING = [
    ("t_object", "class_id:integer name:varchar category_id:integer index:integer "
                 "object_id:integer show:boolean guid:uuid?", "part"),
    ("t_property", "property_id:integer collection_id:integer enum_id:integer? name:varchar "
                   "summary_name:varchar unit_id:integer summary_unit_id:integer "
                   "is_multi_band:boolean is_period:boolean is_summary:boolean lang_id:integer",
     "orders"),
    ("t_key", "key_id:integer membership_id:integer phase_id:integer property_id:integer "
              "period_type_id:integer", "lineitem"),
]


def _listing_sql() -> str:
    lines = []
    for table, columns, source in _LISTING:
        for position, column in enumerate(columns.split(), 1):
            name, kind = column.rstrip("?").split(":")
            required = "false" if column.endswith("?") else "true"
            lines.append(
                f"SELECT '{table}' AS table_name, CAST({position} AS INTEGER) AS position, "
                f"'{name}' AS column_name, '{kind}' AS type, {required} AS required, "
                f'(SELECT count(*) FROM {source}) AS "rows"'
            )
    return "\nUNION ALL ".join(lines)


def _words_sql(values: dict[int, str], otherwise: str) -> str:
    cases = " ".join(f"WHEN {k} THEN {v}" for k, v in values.items())
    return f"CASE event_id % 11 {cases} ELSE {otherwise} END"


def oracle_sql() -> dict[str, str]:
    found: dict[str, str] = {}
    if llm_queries:
        found |= llm_queries.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    for name, sql in (("object", _OBJECT), ("property", _PROPERTY), ("key", _KEY)):
        found[f"load_{name}"] = sql
        for suffix in ("", "_mixed", "_zip", "_prefixed"):
            found[f"ingest_{name}{suffix}"] = sql
    true = "event_id % 11 < 6"
    return found | {
        "ingest_stream": _KEY,
        "rows_by_table": _ROWS_BY_TABLE,
        "rows_by_table_zip": _ROWS_BY_TABLE,
        "load_replaces": _OBJECT,
        "failed_load_keeps_tables": _OBJECT,
        "tables_created": """SELECT 't_object' AS table_name, count(*) AS "rows" FROM part
            UNION ALL SELECT 't_property', 0 UNION ALL SELECT 't_key', 0""",
        "table_listing": _listing_sql(),
        "custom_table": """SELECT CAST(s_suppkey AS INTEGER) AS band, 7 AS grade FROM supplier
            UNION ALL SELECT CAST(2 * s_suppkey AS INTEGER), NULL FROM supplier""",
        "element_profile": _ELEMENTS,
        "element_profile_zip": _ELEMENTS,
        "healed_documents": _OBJECT,
        "zip_members": _OBJECT,
        "document_statuses": """SELECT 'rows_loaded' AS rule, count(*) AS n FROM part WHERE p_partkey % 8 IN (0, 7)
            UNION ALL SELECT CASE p_partkey % 8 WHEN 1 THEN 'encrypted_member' WHEN 2 THEN 'unsupported_compression'
                WHEN 3 THEN 'member_missing' WHEN 4 THEN 'bad_archive' WHEN 5 THEN 'bad_document'
                ELSE 'unknown_encoding' END, count(DISTINCT p_partkey % 8)
            FROM part WHERE p_partkey % 8 NOT IN (0, 7) GROUP BY 1""",
        "fault_places": """SELECT p_partkey AS object_id, true AS at_byte, true AS at_line
            FROM part WHERE p_partkey % 10 IN (0, 3, 5)""",
        "unknown_table_runs": """
            WITH rows AS (SELECT s_suppkey % 8 AS file, s_suppkey AS k,
                          CASE WHEN s_suppkey % 5 < 2 THEN 't_band' ELSE 't_zone' END AS tag FROM supplier)
            SELECT tag, CAST(count(CASE WHEN earlier IS DISTINCT FROM tag THEN 1 END) AS BIGINT) AS runs, count(*) AS "rows"
            FROM (SELECT *, lag(tag) OVER (PARTITION BY file ORDER BY k) AS earlier FROM rows) GROUP BY tag""",
        "malformed_rows": """SELECT p_partkey AS object_id, 'malformed_row' AS rule
            FROM part WHERE p_partkey % 10 IN (0, 3, 5)""",
        "damaged_documents": _OBJECT,
        "spelled_children": """
            SELECT 't_a' AS table_name, s_suppkey AS "key", 'g' || s_suppkey AS guid FROM supplier
            UNION ALL SELECT 't_b', s_suppkey, 'g' || s_suppkey FROM supplier""",
        "two_streams": f"""{_OBJECT}
            UNION ALL SELECT * FROM ({_OBJECT} WHERE NOT {_BAD})""",
        "element_totals": f"""SELECT CAST(sum(elements) AS BIGINT) AS elements,
            CAST(4 AS BIGINT) AS tables, CAST(1 AS BIGINT) AS unknown_tables
            FROM ({_ELEMENTS})""",
        "unknown_tables": """SELECT 't_band' AS tag, count(*) AS "rows" FROM supplier""",
        "rejects": """
            SELECT p_partkey AS object_id, 'missing_column' AS rule, 'name' AS column_name,
                   CAST(NULL AS VARCHAR) AS value FROM part WHERE p_partkey % 10 = 0
            UNION ALL SELECT p_partkey, 'not_convertible', 'class_id', 'abc'
            FROM part WHERE p_partkey % 11 = 0
            UNION ALL SELECT p_partkey, 'null_value', 'category_id', ''
            FROM part WHERE p_partkey % 13 = 0
            UNION ALL SELECT p_partkey, 'out_of_range', 'index', '3000000000'
            FROM part WHERE p_partkey % 17 = 0""",
        "quarantine_keeps_good_rows": f"""SELECT CAST(p_partkey AS INTEGER) AS object_id,
            CAST(p_size AS INTEGER) AS class_id, p_name AS name FROM part WHERE NOT {_BAD}""",
        "ingest_events": f"""
            SELECT 'INFO' AS level, 't_object' AS table_name, 'rows_loaded' AS rule,
                   CAST(NULL AS VARCHAR) AS column_name,
                   CAST(count(*) + count(CASE WHEN NOT {_BAD} THEN 1 END) AS BIGINT) AS occurrences
            FROM part
            UNION ALL SELECT 'INFO', 't_property', 'rows_loaded', NULL, count(*) FROM orders
            UNION ALL SELECT 'INFO', 't_key', 'rows_loaded', NULL, count(*) FROM lineitem
            UNION ALL SELECT 'WARNING', 't_band', 'unknown_table', NULL, count(*) FROM supplier
            UNION ALL SELECT 'ERROR', 't_object', 'missing_column', 'name', count(*)
            FROM part WHERE p_partkey % 10 = 0
            UNION ALL SELECT 'ERROR', 't_object', 'not_convertible', 'class_id', count(*)
            FROM part WHERE p_partkey % 11 = 0
            UNION ALL SELECT 'ERROR', 't_object', 'null_value', 'category_id', count(*)
            FROM part WHERE p_partkey % 13 = 0
            UNION ALL SELECT 'ERROR', 't_object', 'out_of_range', 'index', count(*)
            FROM part WHERE p_partkey % 17 = 0""",
        "uuid_check": f"""SELECT p_partkey AS object_id,
            CASE WHEN p_partkey % 5 <> 3 THEN {_PART_GUID} END AS guid,
            CASE WHEN p_partkey % 5 = 3 THEN 'bad_format' END AS rule FROM part""",
        "object_identifier": f"""SELECT object_id,
            coalesce(guid, class_id || ':' || object_id) AS identifier,
            'TObject(id=' || object_id || ', class_id=' || class_id || ', name=''' || name
            || ''')' AS display, "show" AS is_enabled FROM ({_OBJECT})""",
        "property_identifier": f"""SELECT property_id,
            concat_ws(':', property_id, collection_id, enum_id) AS identifier,
            'TProperty(id=' || property_id || ', name=''' || name || ''', collection_id='
            || collection_id || ')' AS display, enum_id IS NOT NULL AS has_enum,
            is_period AS is_time_varying, is_summary AS is_aggregable FROM ({_PROPERTY})""",
        "varying_properties": f"""SELECT property_id, collection_id, enum_id FROM ({_PROPERTY})
            WHERE enum_id IS NOT NULL AND is_period AND NOT is_summary""",
        "convert_integer": f'SELECT event_id, CAST({_INT} AS INTEGER) AS "integer" FROM events',
        "convert_optional_integer": f"""SELECT event_id, CAST({_INT} AS INTEGER)
            AS optional_integer FROM events""",
        "convert_integer_or_zero": f"""SELECT event_id, CASE WHEN event_id % 9 IN (4, 8) THEN 0
            ELSE CAST({_INT} AS INTEGER) END AS integer_or_zero FROM events""",
        "convert_boolean": f'SELECT event_id, {true} AS "boolean" FROM events',
        "convert_strict_boolean": """SELECT event_id, event_id % 11 = 0 AS strict_boolean
            FROM events""",
        "convert_folded_boolean": """SELECT event_id, CASE WHEN event_id % 11 < 10
            THEN event_id % 11 < 2 END AS folded_boolean FROM events""",
        "convert_text": f"""SELECT event_id, {_words_sql(_TRIMMED, "NULL")} AS "text",
            {_words_sql(_UNTRIMMED, "''")} AS text_or_empty FROM events""",
        "convert_optional_text": """SELECT event_id,
            CASE event_id % 9 WHEN 0 THEN '' || event_id WHEN 1 THEN '' || event_id
            WHEN 2 THEN '+' || event_id WHEN 3 THEN '-' || event_id WHEN 4 THEN ''
            WHEN 5 THEN event_id || '.7' WHEN 6 THEN 'n' || event_id
            WHEN 7 THEN '' || (3000000000 + event_id) END AS optional_text,
            nullif(optional_text, '') AS optional_trimmed FROM events""",
        "convert_uuid": f"""SELECT event_id, CASE WHEN event_id % 6 < 3 THEN {_EVENT_GUID} END
            AS uuid FROM events""",
        "convert_floating": f"SELECT event_id, {_FLOAT} AS floating FROM events",
        "convert_date_time": f"SELECT event_id, {_TIME} AS date_time FROM events",
        "convert_by_type": f"""SELECT event_id, CAST({_INT} AS INTEGER) AS int_value,
            CAST(CASE WHEN event_id % 9 = 7 THEN 3000000000 + event_id ELSE {_INT} END AS BIGINT)
            AS long_value, {_FLOAT} AS double_value,
            CASE WHEN event_id % 11 < 10 THEN event_id % 11 < 2 END AS boolean_value,
            {_words_sql(_UNTRIMMED, "NULL")} AS string_value, {_TIME} AS time_value
            FROM events""",
    }


_FLOAT = """CASE event_id % 6 WHEN 0 THEN event_id + 0.5::DOUBLE WHEN 1 THEN event_id::DOUBLE
            WHEN 2 THEN -100 * event_id::DOUBLE END"""
_TIME = """CASE event_id % 4
    WHEN 0 THEN '2024-01-0' || (event_id % 9 + 1) || ' 03:'
                || lpad('' || (event_id % 60), 2, '0')
    WHEN 1 THEN '2024-02-0' || (event_id % 9 + 1) || ' 13:'
                || lpad('' || (event_id % 60), 2, '0') END"""
_TRIMMED = dict(
    enumerate(
        f"'{w}'" for w in ("true", "TRUE", "1", "yes", "Y", "t", "on", "no", "", "false")
    )
)
_UNTRIMMED = _TRIMMED | {1: "' TRUE '"}
