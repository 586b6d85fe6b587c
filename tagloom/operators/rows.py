"""Records to rows: table tag, state and the XML text of one row each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagloom.functions.convert import WHITESPACE
from tagloom.operators.plain import is_plain, plain_elements
from tagloom.spec import Registry

COMMENT_OR_CDATA = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"
BYTE_ORDER_MARK = "\ufeff"

# States of a row
OK = "ok"  # one row, complete
OUTSIDE = "outside"  # text that belongs to no row
UNCLOSED = "unclosed"  # a row start without an end tag
MISMATCHED = "mismatched"  # another end tag than the start tag
TANGLED = "tangled"  # row starts or ends that do not pair up, open comment or CDATA
ENCODING = "encoding"  # not UTF-8
MALFORMED = "malformed"  # a row the parser refuses
REREAD = "reread"  # a document that was not cut at all
STATES_TO_REREAD = (UNCLOSED, TANGLED, ENCODING, REREAD)

# A tag that may stand outside rows: an end tag, or a start tag with attributes in quotes.
_NAME = r"[A-Za-z_][\w.-]*+(?::[A-Za-z_][\w.-]*+)?+"
_SAFE = r"""(?:[^{quote}<&\x00-\x08\x0b\x0c\x0e-\x1f]|&(?:amp|lt|gt|quot|apos);)*+"""
_VALUE = "(?:" + "|".join(q + _SAFE.replace("{quote}", q) + q for q in "\"'") + ")"
_LOOSE_TAG = rf"(?s)<(?:/{_NAME}\s*+|{_NAME}(?:\s++{_NAME}\s*+=\s*+{_VALUE})*+\s*+/?)>"
# Any tag, with quoted attribute values, and such a value.
_TAG = r"""<[^<>"'!?][^<>"']*+(?:"[^"]*+"[^<>"']*+|'[^']*+'[^<>"']*+)*+>"""
_QUOTED = r""""[^"]*"|'[^']*'"""
_NO_DECLARATION = r"""xmlns:[^\s=]+\s*=\s*(?:""|'')|xmlns:xml(?:ns)?\s*="""
# A start tag, text, and a start tag again: an element inside a child.
_NESTED = r"(?s)^[^>]*>.*?<[^/<>!?][^<>]*(?<!/)>[^<]*<[^/<>!?]"


def _occurrences(text: Column, part: str) -> Column:
    """How often `part` occurs, without a regular expression."""
    rest = F.replace(text, F.lit(part), F.lit(""))
    return ((F.octet_length(text) - F.octet_length(rest)) / len(part)).cast("int")


def row_bytes(record: Column, prefix: str) -> Column:
    """Bytes of a row's record and of the separator that was before it."""
    return F.octet_length(record) + len(f"<{prefix}:t_" if prefix else "<t_")


def line_ends(text: Column) -> Column:
    return _occurrences(text, "\n")


def _starts(text: Column) -> Column:
    """Start tags and empty-element tags; `text` holds no comments or CDATA."""
    return _occurrences(text, "<") - _occurrences(text, "</") - _occurrences(text, "<!")


def _depth(text: Column) -> Column:
    """Elements opened in `text` minus elements closed in it."""
    return _starts(text) - _occurrences(text, "/>") - _occurrences(text, "</")


def split_rows(
    records: DataFrame, registry: Registry, prefix: str = "", decoded: bool = False
) -> DataFrame:
    """(source, split, at, bytes, ends, status, plain, tag, depth, elements, row_xml, loose, foreign) of every record.

    `depth` is the number of elements the record leaves open; over a complete
    document it adds up to 0. `elements` counts the elements of the record. `row_xml` is
    the row alone, whatever follows it cut off. `decoded` says that the text was
    decoded as its XML declaration asks, so that any encoding is fine. `loose` is what
    `loose_tags` finds outside the row. `foreign` are namespace prefixes the row uses and does not declare.
    """
    mark = f"{prefix}:t_" if prefix else "t_"
    end_mark = f"</{mark}"
    record, plain, bare, name, outside, empty, ends, after, status = (
        F.col(c)
        for c in ("record", "plain", "bare", "name", "outside", "empty", "ends", "after", "status")
    )
    head = F.translate(F.substring_index(record, ">", 1), "\t\r\n", "   ")
    lead = F.ltrim(bare, F.lit(WHITESPACE + BYTE_ORDER_MARK))
    parts = (
        records.withColumn("plain", is_plain(record, registry, prefix))
        .withColumn("bare", F.when(plain, record).otherwise(_uncommented(record)))
        .select(
            "source",
            "split",
            "at",
            "source_status",
            "record",
            "plain",
            "bare",
            F.substring_index(F.substring_index(head, " ", 1), "/", 1).alias("name"),
            head.endswith("/").alias("empty"),
            F.when(plain, 1).otherwise(_occurrences(record, end_mark)).alias("ends"),
            F.when(~plain, F.substring_index(record, end_mark, -1)).alias("after"),
            (~plain & ((lead == "") | lead.startswith("<"))).alias("outside"),
        )
    )
    tangled = (
        bare.contains("<!--")
        | bare.contains("-->")
        | bare.contains("<![CDATA[")
        | bare.contains("]]>")
        | bare.contains("t_" if prefix else ":t_")
        & bare.rlike(r"</?t_" if prefix else r"</?[\w.-]+:t_")
    )
    foreign = ~F.is_valid_utf8(record) | record.contains("\x00")
    if not decoded:
        foreign = foreign | (outside & _declares_other_encoding(record))
    inner = F.substring_index(bare, end_mark, 1)
    row_tags = F.when(
        ~plain & ~outside & bare.contains(":"), _bare_tags(F.concat(F.lit(f"<{mark}"), inner, F.when(empty, "").otherwise(f"{end_mark}>")))
    )
    declared_inside = F.exists(F.slice(row_tags, F.lit(2), F.greatest(F.lit(0), F.size(row_tags) - 1)), lambda t: t.contains("xmlns:"))
    end_name = F.rtrim(F.substring_index(after, ">", 1), F.lit(WHITESPACE))
    parts = parts.withColumn(
        "status",
        F.when(record.isNull(), F.col("source_status"))
        .when(plain, OK)
        .when(foreign, ENCODING)
        .when(tangled, TANGLED)
        .when(outside, F.when(ends == 0, OUTSIDE).otherwise(TANGLED))
        .when(empty, F.when(ends == 0, OK).otherwise(TANGLED))
        .when((ends == 0) | ~after.contains(">"), UNCLOSED)
        .when(ends > 1, TANGLED)
        .when(end_name != name, MISMATCHED)
        .when(inner.rlike(_NESTED) | F.coalesce(declared_inside, F.lit(False)), TANGLED)
        .when(_bad_comment(F.substring_index(record, end_mark, 1)), MALFORMED)
        .otherwise(OK),
    )
    behind = F.when(empty, bare).otherwise(F.substring_index(bare, end_mark, -1))
    loose = F.when(outside, lead).when(record.isNull() | plain, "").otherwise(
        F.substring(behind, F.instr(behind, ">") + 1, F.length(behind))
    )
    beside = F.when(outside, record).otherwise(F.substring_index(record, end_mark, -1))
    foreign = F.array_except(_used(row_tags), F.concat(_declared(row_tags), F.array(F.lit(prefix), F.lit("xml"), F.lit("xmlns"))))
    row_xml = (
        F.when(outside | record.isNull(), None)
        .when(empty, F.concat(F.lit("<" + mark), F.substring_index(record, ">", 1), F.lit(">")))
        .when(
            status == OK,
            F.concat(
                F.lit("<" + mark), F.substring_index(record, end_mark, 1), F.lit(end_mark), name,
                F.lit(">"),
            ),
        )
        .otherwise(F.concat(F.lit("<" + mark), record))
    )
    row_start = F.when(outside, 0).otherwise(1)
    return parts.select(
        "source",
        "split",
        "at",
        F.when(outside, F.octet_length(record)).otherwise(row_bytes(record, prefix)).alias("bytes"),
        line_ends(record).alias("ends"),
        "status",
        "plain",
        F.when(~outside, F.concat(F.lit("t_"), name)).alias("tag"),
        # the separator took the start tag of the row with it
        F.when(plain, 0).otherwise(_depth(bare) + row_start).alias("depth"),
        F.when(plain, plain_elements(record))
        .otherwise((_starts(bare) + row_start).cast("bigint"))
        .alias("elements"),
        row_xml.alias("row_xml"),
        F.when(~plain & ((loose != "") | beside.contains("<!--")), loose_tags(loose, beside, prefix)).alias("loose"),
        F.when(F.size(foreign) > 0, foreign).alias("foreign"),
    )


def loose_tags(text: Column, raw: Column, prefix: str = "") -> Column:
    """What stands outside rows.

    `tags`: names of start tags, and of end tags behind a slash, in order. `first_declares`, `declares`: namespace prefixes that the
    first tag and all of them declare; `uses`: prefixes in use, that of the rows included. `else`: whether there is anything that may not be
    well formed or is no tag. `raw` is the text with its comments.
    """
    tags = F.regexp_extract_all(text, F.lit(_LOOSE_TAG), 0)
    rest = F.btrim(F.regexp_replace(text, _LOOSE_TAG, ""), F.lit(WHITESPACE + BYTE_ORDER_MARK))
    bare = F.transform(tags, lambda t: F.regexp_replace(t, _QUOTED, '""'))

    def names(t: Column) -> Column:
        name = F.regexp_extract(t, r"^</?([^\s/>]+)", 1)
        end = F.concat(F.lit("/"), name)
        return F.when(t.startswith("</"), F.array(end)).when(t.endswith("/>"), F.array(name, end)).otherwise(F.array(name))

    def repeats(t: Column) -> Column:
        found = F.regexp_extract_all(t, F.lit(r"\s([^\s=]+)\s*="), 1)
        return F.size(found) != F.size(F.array_distinct(found))

    odd = F.exists(bare, repeats) | F.exists(tags, lambda t: t.rlike(_NO_DECLARATION)) | _bad_comment(raw)
    known = F.array(F.lit("xml"), F.lit("xmlns"))
    uses = F.array_except(_used(bare), known)
    return F.struct(
        F.flatten(F.transform(tags, names)).alias("tags"),
        _declared(F.slice(bare, F.lit(1), F.lit(1))).alias("first_declares"),
        _declared(bare).alias("declares"),
        (F.array_union(uses, F.array(F.lit(prefix))) if prefix else uses).alias("uses"),
        ((rest != "") | odd).alias("else"),
    )


_NAMES = "array<string>"
LOOSE = f"struct<tags:{_NAMES},first_declares:{_NAMES},declares:{_NAMES},uses:{_NAMES},else:boolean>"


def _bare_tags(text: Column) -> Column:
    """The tags of a text, their attribute values empty."""
    return F.transform(F.regexp_extract_all(text, F.lit(_TAG), 0), lambda t: F.regexp_replace(t, _QUOTED, '""'))


def _used(tags: Column) -> Column:
    """Prefixes of the names of tags and attributes."""
    of_tag = lambda t: F.regexp_extract_all(t, F.lit(r"^</?([^\s/<>:=]+):"), 1)
    of_attributes = lambda t: F.regexp_extract_all(t, F.lit(r"\s([^\s/<>:=\"]+):[^\s=]+\s*="), 1)
    return F.array_distinct(F.flatten(F.transform(tags, lambda t: F.concat(of_tag(t), of_attributes(t)))))


def _declared(tags: Column) -> Column:
    """Prefixes that tags declare."""
    return F.array_distinct(F.flatten(F.transform(tags, lambda t: F.regexp_extract_all(t, F.lit(r"\sxmlns:([^\s=]+)\s*="), 1))))


def _bad_comment(text: Column) -> Column:
    """Whether a comment holds two hyphens, or ends with three."""
    found = F.regexp_extract_all(text, F.lit(COMMENT_OR_CDATA), 0)
    inside = lambda c: F.substring(c, F.lit(5), F.length(c) - 7)
    bad = F.exists(found, lambda c: c.startswith("<!--") & (inside(c).contains("--") | inside(c).endswith("-")))
    return F.coalesce(F.when(text.contains("<!--"), bad), F.lit(False))


def _uncommented(text: Column) -> Column:
    """`text` without comments, CDATA sections and processing instructions."""
    special = text.contains("<!") | text.contains("<?")
    return F.when(special, F.regexp_replace(text, COMMENT_OR_CDATA, "")).otherwise(text)


def _declares_other_encoding(record: Column) -> Column:
    declared = F.lower(
        F.regexp_extract(record, r"""<\?xml[^>]*?encoding\s*=\s*["']([\w.-]+)["']""", 1)
    )
    return ~declared.isin("", "utf-8", "utf8", "us-ascii", "ascii")
