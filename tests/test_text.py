import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clausemill.functions import text
from clausemill.functions.text import clean_spaces, exhibit_body, header_key, plain_lines, visible_lines


@pytest.mark.parametrize(
    "markup, lines",
    [
        ("<p>One</p><p> Two </p>", ["One", "Two"]),
        ("a<br>b<br/>c", ["a", "b", "c"]),
        ("<b>5.1</b><i>Title</i>", ["5.1", "Title"]),
        ("one\r\ntwo\x0bthree four\x85five", ["one", "two", "three", "four", "five"]),
        ("&#160;&nbsp; x &amp; y&nbsp;", ["x & y"]),
        ("&lt;p&gt; &#x2019; &#8220;", ["<p> ’ “"]),
        ("<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>x</body></html>", ["T", "x"]),
        ("x<script>var a='</p>'; b<c</script>y", ["x", "y"]),
        ("foo<!-- c > d -->bar", ["foo", "bar"]),
        ("foo</font>bar", ["foobar"]),
        ("<font>foo</font>bar", ["foo", "bar"]),
        ('<div class="a>b">x</div>', ["x"]),
        ("<p title='it>s'>x</p>", ["x"]),
        ("a < b and c > d", ["a < b and c > d"]),
        ("text <p unfinished", ["text"]),
        ("text <!-- unfinished", ["text"]),
        ("<?xml version='1.0'?>x", ["x"]),
        ("<P>Big</P><TABLE><TR><TD>1</TD><TD>2</TD></TR></TABLE>", ["Big", "1", "2"]),
        ("", []),
        ("   \n\t ", []),
    ],
)
def test_visible_lines(markup, lines):
    assert visible_lines(markup) == lines


def test_expressions(spark):
    rows = spark.createDataFrame(
        [("<DOCUMENT>\n<text>a <TEXT> b", "  one\r\n\n two \x85three ", " 5.3  \tTITLE \n x ", "ARTICLE VI -  Foo"), ("no tag", "", "", "a-b")],
        "raw string, plain string, spaced string, header string",
    )
    got = rows.select(
        exhibit_body(F.col("raw")).alias("body"),
        plain_lines(F.col("plain")).alias("lines"),
        clean_spaces(F.col("spaced")).alias("clean"),
        header_key(F.col("header")).alias("key"),
    ).collect()
    assert got[0]["body"] == "a <TEXT> b"
    assert got[0]["lines"] == ["one", "two", "three"]
    assert got[0]["clean"] == "5.3 TITLE \n x"
    assert got[0]["key"] == "article vi-foo"
    assert got[1].asDict() == {"body": "no tag", "lines": [], "clean": "", "key": "a-b"}


def test_document_table_in_arrow():
    page = '<table class="tableFile" summary="Document Format Files"><tr><td>1<td>d<td>x<a> a&amp;b.htm <a>no</a><td> EX-10 <b>.1</b>&nbsp;</table><tr><td>'
    pages = pa.array([page, None, "", page[:-8] + "<tr><td>1<td>2<td><a>open"], pa.string())
    found = text.document_table.func(pages).to_pylist()
    assert found[0] == {"rows": [{"filename": "a&b.htm", "exhibit_type": "EX-10.1"}], "error": None}
    assert found[1]["rows"] is None and found[1]["error"].startswith("TypeError: ")
    assert found[2] == {"rows": [], "error": None} and found[3] == found[0]
