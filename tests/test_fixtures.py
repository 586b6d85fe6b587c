"""The documents that the queries read, and what is looked up in them."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

import tagloom_fixtures as fx
from tests.conftest import SF
from tests.test_outline import splits_of


def test_rows_are_found_at_their_bytes_and_lines_whatever_the_pieces(spark, tmp_path):
    texts = ["aé\n<r>1</r>\n\n<r>é\n2</r>", "<r>3</r>" + "\n" * 50 + "<r>4</r>"]
    asked = []
    for k, text in enumerate(texts):
        data = text.encode()
        (tmp_path / f"{k}.txt").write_bytes(data)
        for row in (r + "</r>" for r in text.split("</r>")[:-1]):
            row = row[row.index("<r>") :]
            at = data.index(row.encode())
            asked.append((f"file://{tmp_path}/{k}.txt", at, data[:at].count(b"\n") + 1, row))
    asked.append((asked[0][0], 1, 7, "<r>"))  # a wrong place
    rejects = spark.createDataFrame(asked, "source string, offset bigint, line bigint, row_xml string")
    files = fx.list_files(spark, str(tmp_path)).select("source").collect()
    rejects = rejects.withColumn("source", F.concat(F.lit(files[0].source[: -len("0.txt")]), F.substring("source", -5, 5)))
    for piece in (3, 7, 1 << 20):
        found = fx.rows_at(spark, str(tmp_path), rejects, piece).collect()
        assert sorted((r.line == r.line_there, r.there == r.row_xml) for r in found) == [(False, False)] + [(True, True)] * 4


def test_unfinished_documents_are_whole_but_for_their_end(spark):
    with splits_of(spark, 1000):
        folder = fx.unfinished_documents(spark, SF)
    texts = [p.read_text() for p in Path(folder.removeprefix("file:")).glob("*.txt")]
    assert len(texts) == fx.FILES and all(t.startswith("<?xml") and t.rstrip().endswith("</t_object>") for t in texts)


def test_rows_are_dealt_to_documents_without_a_sort(spark):
    rows = fx.everything(spark, SF)
    plan = rows._jdf.queryExecution().toString()
    assert "RoundRobin" not in plan and rows.rdd.getNumPartitions() == fx.FILES


def test_rows_are_written_as_to_xml_does(spark):
    rows = spark.createDataFrame([(1, "a<&>\"'", None), (None, "", "]]>"), (-3, " é\n", "&amp;")], "n int, s string, o string")
    row = F.struct("n", "s", "o")
    shaped = rows.select(row.alias("t_x"))
    expected = sorted(r[0] for r in rows.select(F.to_xml(row, {"rowTag": "t_x"})).collect())
    assert sorted(r.value for r in fx._texts(shaped).collect()) == expected


def test_what_is_shuffled_are_columns_of_the_tables(spark):
    """Values made from others (ten of a property's, GUIDs) come after the deal."""
    plan = fx.everything(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    before = plan[plan.index("RepartitionByExpression") :]
    assert "md5(" in plan and "md5(" not in before and "enum_id" not in before and "lang_id" not in before
