"""Lines shared by many sites."""

from __future__ import annotations

import duckdb
import pytest

from gapwise.llm import lines
from gapwise.llm.oracles import LLM_ORACLES
from gapwise.llm.queries import op7_line_dedup

SCHEMA = "doc_id long, text string, source string, n_removed int, cut string"
BODY = "a body of words that only this page holds, number {}, long enough to outweigh the rest"


def left(spark, rows, **options):
    df = spark.createDataFrame([(*r, 7, "cut") for r in rows], SCHEMA)
    out = lines.remove_boilerplate(df, **options)
    assert out.columns == [*df.columns, "n_lines", "_n_removed"]
    return {r["doc_id"]: (r["text"], r["n_lines"], r["_n_removed"]) for r in out.collect()}


def pages(n, line, start=0):
    return [(start + i, f"{BODY.format(start + i)}\n{line}", f"s{i}") for i in range(n)]


def test_threshold_is_exact(spark):
    got = left(spark, pages(12, " All rights RESERVED\r") + pages(11, "eleven", 100))
    assert got[3] == (BODY.format(3), 2, 1)
    assert got[105] == (BODY.format(105) + "\neleven", 2, 0)


def test_one_site_many_rows(spark):
    rows = [(i, f"{BODY.format(i)}\nfooter", "only") for i in range(300)]
    assert all(r[2] == 0 for r in left(spark, rows).values())


def test_sites_far_above_threshold_use_sketches_alone(spark):
    got = left(spark, pages(80, "menu"), min_sites=40)
    assert all(r == (BODY.format(i), 2, 1) for i, r in got.items())
    assert all(r[2] == 0 for r in left(spark, pages(30, "menu"), min_sites=40).values())


def test_copies_stay_whole(spark):
    rows = [(i, "the same page\nof two lines", f"s{i}") for i in range(20)]
    assert set(left(spark, rows).values()) == {("the same page\nof two lines", 2, 0)}


def test_nulls_blank_lines_and_repeats(spark):
    rows = pages(12, "menu") + [
        (50, None, "s0"),
        (51, "", "s0"),
        (52, "\n\nmenu\n" + BODY, None),
        (53, f"menu\n{BODY}\nmenu\n", "s1"),
        (54, "menu", "s2"),
        (0, f"{BODY.format(0)}\nmenu", "s0"),
    ]
    df = spark.createDataFrame([(*r, 7, "cut") for r in rows], SCHEMA)
    out = lines.remove_boilerplate(df)
    assert out.count() == len(rows)
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["_n_removed"]) for r in out.collect()}
    assert got[50] == (None, 0, 0) and got[51] == ("", 1, 0)
    assert got[52] == ("\n\n" + BODY, 4, 1)
    assert got[53] == (f"{BODY}\n", 4, 2)
    assert got[54] == ("menu", 1, 0)
    assert got[0] == (BODY.format(0), 2, 1)


def test_long_text_and_empty_table(spark):
    many = "".join(f"menu\nline {k} of a long text\n" for k in range(60_000))
    got = left(spark, pages(12, "menu") + [(99, "menu\n" + "x" * 2_000_000, "z"), (98, many, "z")])
    assert got[99] == ("x" * 2_000_000, 2, 1)
    assert got[98] == (many.replace("menu\n", ""), 120_001, 60_000)
    assert left(spark, []) == {}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.01"])
def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(
        f"SELECT doc_id, n_lines, n_removed, kept_chars, kept_sha256 FROM ({LLM_ORACLES['op7_line_dedup']})"
    ).fetchall()
    got = [tuple(r) for r in op7_line_dedup(spark, folder).collect()]
    assert sorted(got) == sorted(want)
    assert sum(r[2] for r in got) > 100
