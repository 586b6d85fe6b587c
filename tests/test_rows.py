"""What a row element turns into, by cutting the text and by reading the whole document."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tagloom import Source, default_registry
from tagloom.operators.plain import is_plain, ordered_text, ordered_texts, plain_child
from tagloom.operators.typed import good_rows, violations
from tagloom.plans.ingest import stage
from tagloom.plans.workspace import work_folder
from tests.helpers import document, row, values

REGISTRY = default_registry()

# name: (documents, good t_object rows, violations as (rule, column))
CASES = {
    "plain": ([document(row(), row())], [values()] * 2, []),
    "no declaration": ([document(row(), head="")], [values()], []),
    "byte order mark": ([b"\xef\xbb\xbf" + document(row()).encode()], [values()], []),
    "windows line ends": ([document(row()).replace("\n", "\r\n")], [values()], []),
    "one line": ([document(row(), row()).replace("\n", "")], [values()] * 2, []),
    "root is the row": ([row(head="x").replace("\n    <head>x</head>", "")], [values()], []),
    "one level deeper": ([document("<wrap>", row(), "</wrap>")], [values()], []),
    "attribute on the row": ([document(row(attributes=' k="a>b/" j="2"'))], [values()], []),
    "attribute on a child": (
        [document(row(name=None, extra='<name k="1">SEN</name>'))], [values()], [],
    ),
    "duplicate child": ([document(row(extra="<name>last</name>"))], [values(name="last")], []),
    "duplicate empty child": ([document(row(extra="<name/>"))], [values(name="")], []),
    "undeclared child": ([document(row(extra="<other>1</other>"))], [values()], []),
    "grandchild of a declared name": (
        [document(row(extra="<other><name>no</name></other>"))], [values()], [],
    ),
    "other case of a child": ([document(row(name=None, extra="<NAME>SEN</NAME>"))], [values()], []),
    "lower case guid": (
        [document(row(GUID=None, extra="<guid>98246b27-0c91-4b26-8f8b-5537c56b6dc0</guid>"))],
        [values()],
        [],
    ),
    "missing optional": ([document(row(GUID=None))], [values(guid=None)], []),
    "empty optional": ([document(row(GUID=""))], [values(guid=None)], []),
    "missing required": ([document(row(name=None))], [], [("missing_column", "name")]),
    "empty required text": ([document(row(name=""))], [values(name="")], []),
    "empty required number": ([document(row(index=" "))], [], [("null_value", "index")]),
    "self-closed child": ([document(row(name=None, extra="<name />"))], [values(name="")], []),
    "space around values": (
        [document(row(name=" \n\tSEN ", index=" 3 ", show=" TRUE "))], [values()], [],
    ),
    "true words": (
        [document(*[row(show=w) for w in ("TRUE ", "1", "yes", "y", "t", "Y")])], [values()] * 6, [],
    ),
    "false words": (
        [document(*[row(show=w) for w in ("on", "no", "", "false", "x")])],
        [values(show=False)] * 5,
        [],
    ),
    "numbers": ([document(row(index=" 12 "), row(index="+5"))], [values(index=12), values(index=5)], []),
    "no numbers": (
        [document(*[row(index=w) for w in ("1_000", "12.7", "3000000000", "abc")])],
        [],
        [("not_convertible", "index")] * 3 + [("out_of_range", "index")],
    ),
    "guid notations": (
        [
            document(
                row(GUID="{98246B27-0C91-4B26-8F8B-5537C56B6DC0}"),
                row(GUID="98246b270c914b268f8b5537c56b6dc0"),
            )
        ],
        [values()] * 2,
        [],
    ),
    "bad guid": ([document(row(GUID="nope"))], [], [("bad_format", "guid")]),
    "two violations": (
        [document(row(name=None, index="x"))],
        [],
        [("missing_column", "name"), ("not_convertible", "index")],
    ),
    "self-closed rows": (
        [document("<t_object/>", "<t_object />", row())],
        [values()],
        [("missing_column", c) for c in ("class_id", "name", "category_id", "index", "object_id", "show")]
        * 2,
    ),
    "entities": (
        [document(row(name="a &amp; b &lt;c&gt; &#65;"))], [values(name="a & b <c> A")], [],
    ),
    "cdata": ([document(row(name="<![CDATA[a <b> & c]]>"))], [values(name="a <b> & c")], []),
    "row start in cdata": (
        [document(row(name="<![CDATA[<t_object><name>x</name></t_object>]]>"))],
        [values(name="<t_object><name>x</name></t_object>")],
        [],
    ),
    "comment in a row": ([document(row(extra="<!-- <name>no</name> -->"))], [values()], []),
    "row in a comment": ([document("<!-- ", row(name="no"), "-->", row())], [values()], []),
    "rows in a comment": (
        [document(row(), "<!-- ", row(name="a"), row(name="b"), row(name="c"), "-->")], [values()], [],
    ),
    "arrow in text": ([document(row(name="a --> b"))], [values(name="a --> b")], []),
    "tag end in text": ([document(row(name="a /> b"))], [values(name="a /> b")], []),
    "processing instruction": ([document("<?x <t_object> ?>", row())], [values()], []),
    "row in a row": (
        [document(row(extra=row(name="inner")))], [values(name="inner"), values()], [],
    ),
    "other row in a row": ([document(row(extra="<t_band><name>no</name></t_band>"))], [values()], []),
    "unknown table": ([document("<t_band><a>1</a></t_band>", row())], [values()], []),
    "latin-1": (
        [document(row(name="ñ"), head='<?xml version="1.0" encoding="iso-8859-1"?>').encode("latin-1")],
        [values(name="ñ")],
        [],
    ),
    "utf-8 letters": ([document(row(name="ñ 日本"))], [values(name="ñ 日本")], []),
    "no rows": ([document()], [], []),
    "several documents": ([document(row()), document(row(name="b"))], [values(), values(name="b")], []),
    "long row": ([document(row(extra="<x>1</x>" * 3000))], [values()], []),
}
# documents that are not well formed: only cutting keeps the other rows apart
BROKEN = {
    "mismatched child": (
        [document(row(), row(name=None, extra="<name>a</nome>"), row())], [values()] * 2,
        [("malformed_row", None)],
    ),
    "mismatched row end": (
        [document(row(), row().replace("</t_object>", "</t_other>"), row())], [values()] * 2,
        [("malformed_row", None)],
    ),
    "truncated in a value": (
        [document(row(), row()).rpartition("<object_id>")[0] + "<object_id>7"], [values()],
        [("malformed_row", None)],
    ),
    "unknown entity": ([document(row(), row(name="&nope;"))], [values()], [("malformed_row", None)]),
    "control character": ([document(row(), row(name="\x01"))], [values()], [("malformed_row", None)]),
}


def _staged(spark, folder_of, kind, cases):
    """Stage the documents of all cases at once: {case: (good rows, violations)}."""
    documents = [(name, d) for name, (given, _, _) in cases.items() for d in given]
    folder = folder_of(*[d for _, d in documents])
    case_of = {f"d{i}.xml": name for i, (name, _) in enumerate(documents)}
    found = {name: ([], []) for name in cases}
    with work_folder(spark) as work:
        typed, _ = stage(spark, Source(folder, kind), REGISTRY, work)
        good = typed.filter((F.col("tag") == "t_object") & F.col("good"))
        for line in good.select("source", "t_object.*").collect():
            found[case_of[line.source.rsplit("/", 1)[-1]]][0].append(tuple(line)[1:])
        bad = typed.filter(~F.col("good")).select(
            "source", F.explode(violations(REGISTRY)).alias("v")
        )
        for line in bad.select("source", "v.rule", "v.column").collect():
            found[case_of[line.source.rsplit("/", 1)[-1]]][1].append(tuple(line)[1:])
        assert good_rows(typed, REGISTRY["t_object"]).count() == good.count()
    return found


@pytest.fixture(scope="module")
def folder_of(tmp_path_factory):
    def write(*documents):
        folder = tmp_path_factory.mktemp("documents")
        for number, document_ in enumerate(documents):
            data = document_.encode() if isinstance(document_, str) else document_
            (folder / f"d{number}.xml").write_bytes(data)
        return str(folder)

    return write


@pytest.fixture(scope="module")
def cut(spark, folder_of):
    return _staged(spark, folder_of, "text", CASES | BROKEN)


@pytest.fixture(scope="module")
def whole(spark, folder_of):
    return _staged(spark, folder_of, "whole", CASES)


def _check(found, good, bad):
    assert sorted(found[0], key=repr) == sorted(good, key=repr)
    assert sorted(found[1], key=repr) == sorted(bad, key=repr)


@pytest.mark.parametrize("name", CASES)
def test_cut(cut, name):
    _check(cut[name], *CASES[name][1:])


@pytest.mark.parametrize("name", BROKEN)
def test_cut_broken(cut, name):
    _check(cut[name], *BROKEN[name][1:])


@pytest.mark.parametrize("name", CASES)
def test_whole(whole, name):
    _check(whole[name], *CASES[name][1:])


def test_records_in_declared_order_give_all_texts_at_once(spark):
    """`ordered_texts` takes no record that `is_plain` refuses, and finds what `plain_child` finds."""
    children = lambda changes: {f.source: "1" for f in REGISTRY["t_property"].fields} | changes
    write = lambda c: "property>" + "".join(f"\n  <{k}>{v}</{k}>" for k, v in c.items() if v is not None) + "\n</t_property>\n"
    ordered = [write(children(c)) for c in ({}, {"enum_id": None}, {"enum_id": "", "name": " é$1\\ \t"}, {"name": "]]", "lang_id": ""})]
    others = [
        write(dict(reversed(children({}).items()))),
        *[write(children({"name": v})) for v in (None, "a]]>", "a&lt;", "a\r", "a\x01", "￾", "�", "x" * 9000)],
        write(children({})).replace("</name>", "</name><name>2</name>"),
        write(children({})).replace("</name>", "</name><more>2</more>"),
        write(children({})).replace("enum_id", "Enum_id"),
        write(children({})) + "</root>",
        write(children({})).replace("</t_property>", "</t_key>"),
        "band><band_id>1</band_id></t_band>",
    ]
    record = F.col("record")
    rows = spark.createDataFrame([(r,) for r in ordered + others], "record string").unionAll(
        spark.createDataFrame([(bytearray(ordered[0].encode().replace(b"<name>1", b"<name>\xff")),)], "record binary").selectExpr("cast(record as string)")
    )
    fields = REGISTRY["t_property"].fields
    texts = ordered_texts(record, REGISTRY)
    found = rows.select(
        texts.isNotNull().alias("taken"),
        is_plain(record, REGISTRY).alias("plain"),
        F.array(*[ordered_text(texts, i, f.required) for i, f in enumerate(fields)]).alias("at_once"),
        F.array(*[plain_child(record, f.source) for f in fields]).alias("singly"),
    ).collect()
    assert [r.taken for r in found] == [True] * len(ordered) + [False] * (len(others) + 1)
    assert all(r.plain and r.at_once == r.singly for r in found if r.taken)
