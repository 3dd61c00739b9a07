"""Raw exhibit text to lines.

Reading HTML is the only step of the engine that runs in Python, in Arrow batches. Plain text is
split natively.
"""

from __future__ import annotations

import html
import re
import sys
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The two functions below travel to the executors by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

READ_RESULT = T.StructType([T.StructField("lines", T.ArrayType(T.StringType())), T.StructField("error", T.StringType())])
TABLE_ROWS = T.ArrayType(
    T.StructType([T.StructField("filename", T.StringType()), T.StructField("exhibit_type", T.StringType())])
)
TABLE_RESULT = T.StructType([T.StructField("rows", TABLE_ROWS), T.StructField("error", T.StringType())])

_ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')|=)*+"""
_MARKUP = re.compile(
    rf"<!--.*?(?:--!?>|\Z)"
    rf"|<(?P<hidden>script|style)\b{_ATTRIBUTES}>.*?(?:</(?P=hidden)\s*>|\Z)"
    rf"|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*)(?P<attributes>{_ATTRIBUTES})(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""([^\s=/]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")


def _tokens(markup: str) -> Iterator[tuple[str, re.Match | None]]:
    """Text before each piece of markup, with that piece; the last text comes with None."""
    at = 0
    for piece in _MARKUP.finditer(markup):
        yield markup[at : piece.start()], piece
        at = piece.end()
    yield markup[at:], None


def visible_lines(markup: str) -> list[str]:
    """X2 for one document: its text nodes, split at line boundaries, stripped, empties dropped.

    A closing tag whose element was never opened is no node boundary.
    """
    opened: Counter[str] = Counter()
    parts = []
    for text, piece in _tokens(markup):
        parts.append(text)
        name = piece["name"].lower() if piece is not None and piece["name"] else None
        if name and piece["close"] and name != "p":
            if not opened[name]:
                continue
            opened[name] -= 1
        elif name:
            opened[name] += 1
        parts.append("\n")
    stripped = (line.strip() for line in html.unescape("".join(parts)).splitlines())
    return [line for line in stripped if line]


@F.pandas_udf(READ_RESULT)
def html_lines(markup: pd.Series) -> pd.DataFrame:
    """Lines of each document, or the error that kept one document from being read."""
    lines, errors = [], []
    for document in markup:
        try:
            lines.append(visible_lines(document))
            errors.append(None)
        except Exception as problem:  # one bad document must not fail the job
            lines.append(None)
            errors.append(f"{type(problem).__name__}: {problem}")
    return pd.DataFrame({"lines": lines, "error": errors})


# Not pure as far as the optimizer knows: a filter on the result may then not be moved below it, which
# would read every document twice.
html_lines = html_lines.asNondeterministic()


def _add_text(cell: dict, text: str, link: bool) -> None:
    text = (html.unescape(text) if "&" in text else text).strip()
    cell["text"] += text
    if link:
        cell["link"] += text


def _document_rows(page: str) -> list[dict[str, str]]:
    """S5 for one index page: file name and type of each row of the first document table."""
    rows: list[list[dict]] = []
    depth, at = 0, 0
    link = False
    cell = None  # the last cell of the last row, if it has one
    for piece in _MARKUP.finditer(page):
        start, before = piece.start(), at
        at = piece.end()
        if cell is not None and start > before:
            _add_text(cell, page[before:start], link)
        _, closing, name, attributes = piece.groups()
        if not name:
            continue
        name = name.lower()
        if name == "table":
            if closing and depth:
                depth -= 1
                if not depth:
                    break
            elif not closing:
                given = {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(attributes)}
                wanted = "tableFile" in given.get("class", "").split() and given.get("summary") == "Document Format Files"
                depth += 1 if depth or wanted else 0
        elif not depth:
            continue
        elif name == "td" and not closing and rows:
            cell = {"text": "", "link": "", "linked": False}
            rows[-1].append(cell)
        elif name == "tr" and not closing:
            rows.append([])
            cell = None
        elif name == "a" and cell is not None:
            # Only the first link of a cell names the file.
            link = not closing and not cell["linked"]
            cell["linked"] = True
    else:
        if cell is not None:
            _add_text(cell, page[at:], link)
    return [
        {"filename": cells[2]["link"], "exhibit_type": cells[3]["text"]}
        for cells in rows
        if len(cells) >= 4 and cells[2]["linked"]
    ]


@F.arrow_udf(TABLE_RESULT)
def document_table(page: pa.Array) -> pa.Array:
    """The rows of a filing's document table, or the error that kept a page from being read."""
    rows, errors = [], []
    for text in page.to_pylist():
        try:
            rows.append(_document_rows(text))
            errors.append(None)
        except Exception as problem:  # one bad page must not fail the job
            rows.append(None)
            errors.append(f"{type(problem).__name__}: {problem}")
    kind = pa.list_(pa.struct([("filename", pa.string()), ("exhibit_type", pa.string())]))
    return pa.StructArray.from_arrays([pa.array(rows, kind), pa.array(errors, pa.string())], ["rows", "error"])


document_table = document_table.asNondeterministic()


def exhibit_body(raw: Column) -> Column:
    """Everything after the first ``<TEXT>`` tag; without one, the whole text."""
    return F.element_at(F.split(raw, "(?i)<TEXT>", 2), -1)


# The white space that is stripped from lines.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_space(text: Column) -> Column:
    """Remove Unicode white space at both ends (plain ``trim`` removes U+0020 only)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def plain_lines(text: Column) -> Column:
    """X2 for plain text, natively: split at line boundaries, strip, drop empties."""
    pieces = F.split(text, r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]")
    return F.filter(F.transform(pieces, strip_space), lambda line: line != "")


def collapse_spaces(text: Column) -> Column:
    """Runs of blanks, tabs and no-break spaces become one blank; line breaks stay.

    Single blanks, which are most of them, are not matched.
    """
    return F.regexp_replace(text, r"[\t\x{a0}][ \t\x{a0}]*| [ \t\x{a0}]+", " ")


def clean_spaces(text: Column) -> Column:
    """Collapsed spaces, stripped at both ends."""
    return strip_space(collapse_spaces(text))


def header_key(header: Column) -> Column:
    """The spelling under which two headers of a document count as the same."""
    return F.regexp_replace(F.lower(header), r"(?U)[\s\x1c-\x1f]*-[\s\x1c-\x1f]*", "-")
