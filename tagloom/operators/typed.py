"""Rows to typed tables: child texts, conversion, violations.

There are two ways: `type_plain` for the mass of simple rows without a violation,
`type_rows` for all others. A typed row has, per table, a struct of its values (NULL for rows of other
tables), and for a bad row also the texts the values came from, from which its
violations are told. Columns besides these: source, split and at (the place in the source; null where it was read
as a whole), status, tag, known, depth, elements, loose, foreign, good, row_xml (bad rows, and those with foreign
prefixes), bytes and ends (of the record: its length, with the separator before it, and its line ends), offset and line (of documents read as a whole).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tagloom.functions.convert import strip
from tagloom.operators.plain import is_plain, is_required, ordered_text, ordered_texts, plain_child, plain_elements, plain_tag
from tagloom.operators.rows import LOOSE, MALFORMED, OK, line_ends, row_bytes
from tagloom.spec import Field, Registry, TableSpec

CORRUPT = "_corrupt_record"
VIOLATION = "struct<rule:string,column:string,value:string>"


def type_plain(records: DataFrame, registry: Registry, prefix: str = "") -> DataFrame:
    """(source, split, at, source_status, tag, done, elements, bytes, ends, record, one struct per table).

    Types the plain records without a violation; `done` is true for them. For the
    others it is false, and `record` keeps the text for `split_rows` and
    `type_rows`. All tables are typed in one pass, so a source is read once
    however many tables it holds. Good rows of unknown tables are done, too.
    """
    record, texts, tag = F.col("record"), F.col("texts"), F.col("tag")
    ordered = records.select("source", "split", "at", "source_status", "record", ordered_texts(record, registry, prefix).alias("texts"))
    tagged = ordered.select("*", F.when(texts.isNotNull() | is_plain(record, registry, prefix), plain_tag(record)).alias("tag"))
    text = {
        (spec.name, c): F.when(texts.isNotNull(), ordered_text(texts, i, is_required(spec, c))).otherwise(plain_child(record, c, prefix))
        for spec in registry
        for i, c in enumerate(spec.children)
    }
    valued = tagged.select(
        "*",
        *[
            F.when(
                tag == spec.name,
                F.struct(*[_plain_value(text[spec.name, f.source], f).alias(f.target) for f in spec.fields]),
            ).alias(spec.name)
            for spec in registry
        ],
    )
    # a NULL is fine where an optional child is absent or empty; anything else that
    # gives NULL is left to the general way to judge
    done = F.lit(True)
    for spec in registry:
        fine = [
            F.col(spec.name).getField(f.target).isNotNull()
            | (F.lit(False) if f.required else F.coalesce(text[spec.name, f.source] == "", F.lit(True)))
            for f in spec.fields
        ]
        done = F.when(tag == spec.name, reduce(and_, fine)).otherwise(done)
    judged = valued.withColumn("done", tag.isNotNull() & done)
    return judged.select(
        "source",
        "split",
        "at",
        "source_status",
        "tag",
        "done",
        F.when(F.col("done"), plain_elements(record)).alias("elements"),
        F.when(F.col("done"), row_bytes(record, prefix)).alias("bytes"),
        F.when(F.col("done"), line_ends(record)).alias("ends"),
        F.when(~F.col("done"), record).alias("record"),
        *[F.when(F.col("done"), F.col(name)).alias(name) for name in registry.names()],
    )


def _plain_value(text: Column, field: Field) -> Column:
    return field.value(strip(text) if field.minds_space else text)


def plain_rows(typed_plain: DataFrame, like: DataFrame, registry: Registry) -> DataFrame:
    """The done rows of `type_plain` with the columns of `type_rows`."""
    fixed = {
        "status": F.lit(OK),
        "depth": F.lit(0),
        "known": registry.is_known(F.col("tag")),
        "good": F.lit(True),
    }
    kept = {"source", "split", "at", "bytes", "ends", "tag", "elements", *registry.names()}
    return typed_plain.filter("done").select(
        *[
            F.col(c.name)
            if c.name in kept
            else fixed.get(c.name, F.lit(None).cast(c.dataType)).alias(c.name)
            for c in like.schema
        ]
    )


def type_rows(rows: DataFrame, registry: Registry) -> DataFrame:
    """Typed rows of the general way.

    Input: `tagloom.operators.rows.split_rows` or
    `tagloom.sources.whole.read_whole_rows`; rows of whole documents have no XML
    text of their own, `row_xml` then is their fields as JSON.
    """
    tag, whole = F.col("tag"), "fields" in rows.columns
    known = tag.isNotNull() & registry.is_known(tag)
    parsed = rows.select(
        "*",
        known.alias("known"),
        F.when(tag.isNotNull() & (F.col("status") == OK), _children(rows, registry)).alias("children"),
    )
    sound = F.col("children").isNotNull() & F.col(f"children.{CORRUPT}").isNull()
    broken = tag.isNotNull() & (F.col("status") == OK) & ~sound
    parsed = parsed.withColumn("status", F.when(broken, MALFORMED).otherwise(F.col("status")))
    raw = parsed.select(
        "*",
        *[
            F.when(
                (tag == spec.name) & sound,
                F.struct(
                    *[strip(F.col("children").getField(c)).alias(c) for c in spec.children]
                ),
            ).alias(_raw_name(spec))
            for spec in registry
        ],
    )
    judged = raw.select("*", *_values(registry)).withColumn(
        "good",
        F.when(tag.isNull(), True).when(F.col("status") != OK, False).otherwise(_good(registry)),
    )
    bad = ~F.col("good")
    row_xml = F.to_json("fields") if whole else F.col("row_xml")
    cut = {"split": "bigint", "bytes": "int", "ends": "int", "loose": LOOSE, "foreign": "array<string>"}
    own = {c: (F.lit(None).cast(kind) if whole else F.col(c)).alias(c) for c, kind in cut.items()}
    own |= {c: (F.col(c) if whole else F.lit(None).cast("bigint")).alias(c) for c in ("offset", "line")}
    return judged.select(
        "source",
        own["split"],
        "at",
        own["bytes"],
        own["ends"],
        own["offset"],
        own["line"],
        "status",
        "tag",
        "known",
        "depth",
        F.col("elements").cast("bigint").alias("elements"),
        own["loose"],
        own["foreign"],
        "good",
        F.when(bad | own["foreign"].isNotNull(), row_xml).alias("row_xml"),
        *registry.names(),
        *[F.when(bad, F.col(_raw_name(s))).alias(_raw_name(s)) for s in registry],
    )


def untyped_rows(rows: DataFrame, registry: Registry) -> DataFrame:
    """What counts and outlines need of `type_rows`, with no values: whether rows are sound, of which table, and what is around them."""
    tag, whole = F.col("tag"), "fields" in rows.columns
    if not whole:
        parsed = F.when(tag.isNotNull() & (F.col("status") == OK) & ~F.col("plain"), _children(rows, registry))
        broken = F.coalesce(parsed.getField(CORRUPT).isNotNull(), F.lit(False))
        rows = rows.withColumn("status", F.when(broken, MALFORMED).otherwise(F.col("status")))
    cut = {"split": "bigint", "loose": LOOSE, "foreign": "array<string>"}
    own = {c: (F.lit(None).cast(kind) if whole else F.col(c)).alias(c) for c, kind in cut.items()}
    return rows.select(
        "source", own["split"], "at", "status", "tag", (tag.isNotNull() & registry.is_known(tag)).alias("known"), "depth",
        F.col("elements").cast("bigint").alias("elements"), own["loose"], own["foreign"], (tag.isNull() | (F.col("status") == OK)).alias("good"),
    )


def _children(rows: DataFrame, registry: Registry) -> Column:
    """Texts of the declared children as a struct, absent ones NULL.

    Names match regardless of case, the last of several equal children counts,
    other children and all attributes are dropped.
    """
    names = registry.children()
    if "fields" in rows.columns:
        fields = F.col("fields")
        values = [F.try_element_at(fields, F.lit(n.lower())).alias(n) for n in names]
        return F.struct(*values, F.lit(None).cast("string").alias(CORRUPT))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])
    options = {"ignoreNamespace": "true", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_xml(F.col("row_xml"), schema, options)


def _values(registry: Registry) -> list[Column]:
    """One struct of converted values per table, from the raw texts."""
    return [
        F.when(
            F.col(_raw_name(spec)).isNotNull(),
            F.struct(*[f.value(_raw(spec, f)).alias(f.target) for f in spec.fields]),
        ).alias(spec.name)
        for spec in registry
    ]


def _good(registry: Registry) -> Column:
    """Has the row no bad value? True for rows of unknown tables."""
    good = F.lit(True)
    for spec in registry:
        sound = F.col(spec.name).isNotNull()
        fields = reduce(and_, [~_is_bad(spec, f) for f in spec.fields])
        good = F.when(F.col("tag") == spec.name, sound & fields).otherwise(good)
    return good


def _raw_name(spec: TableSpec) -> str:
    return f"{spec.name}__raw"


def _raw(spec: TableSpec, field: Field) -> Column:
    return F.col(_raw_name(spec)).getField(field.source)


def _is_bad(spec: TableSpec, field: Field) -> Column:
    missing = F.col(spec.name).getField(field.target).isNull()
    if field.required:
        return missing
    raw = _raw(spec, field)
    return missing & raw.isNotNull() & (raw != "")


def violations(registry: Registry) -> Column:
    """The violated rules of a bad typed row, in column order."""
    malformed = _violation("malformed_row", None, F.coalesce("row_xml", "status"))
    found = F.when(F.col("status") != OK, F.array(malformed))
    for spec in registry:
        is_table = F.col("tag") == spec.name
        found = found.when(is_table & F.col(_raw_name(spec)).isNull(), F.array(malformed))
        found = found.when(is_table, _field_violations(spec))
    return found


def _field_violations(spec: TableSpec) -> Column:
    none = F.array().cast(f"array<{VIOLATION}>")
    return F.concat(
        *[
            F.when(_is_bad(spec, f), F.array(_violation(_rule(spec, f), f.target, _raw(spec, f))))
            .otherwise(none)
            for f in spec.fields
        ]
    )


def _rule(spec: TableSpec, field: Field) -> Column:
    raw = _raw(spec, field)
    return (
        F.when(raw.isNull(), "missing_column")
        .when(raw == "", "null_value")
        .otherwise(field.kind.fault(raw))
    )


def _violation(rule: Column | str, column: str | None, value: Column) -> Column:
    return F.struct(
        (F.lit(rule) if isinstance(rule, str) else rule).alias("rule"),
        F.lit(column).cast("string").alias("column"),
        value.alias("value"),
    )


def good_rows(typed: DataFrame, spec: TableSpec) -> DataFrame:
    """The table: declared columns in declaration order, bad rows left out."""
    return typed.filter((F.col("tag") == spec.name) & F.col("good")).select(
        *[F.col(spec.name).getField(c).alias(c) for c in spec.columns]
    )


def rejected_rows(typed: DataFrame, spec: TableSpec, registry: Registry) -> DataFrame:
    """(source, violations, row_xml, offset, line) of the rows `good_rows` leaves out; the last two as `typed` has them."""
    return typed.filter((F.col("tag") == spec.name) & ~F.col("good")).select(
        "source", violations(registry).alias("violations"), "row_xml", "offset", "line"
    )
