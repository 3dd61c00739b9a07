"""What makes one line of a contract a section header.

Every function maps a line column to a column, so it works in a row-wise ``select`` and inside
``transform`` over an array of lines.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The longest header, the most words in a title, and the connectors a title may
# contain in lower case.
MAX_HEADER_CHARS = 100
MAX_TITLE_WORDS = 8
CONNECTORS = ["of", "on", "in", "for", "and", "to", "the", "a", "an", "or", "by", "with", "from"]

# ``(?U)`` gives the Unicode meaning of \s, \d and \b. \x1c-\x1f are spaces too, which Java leaves out.
_SPACE = r"[\s\x1c-\x1f]"
_GAP = r"[\s\x1c-\x1f,/\-]"
_WORD = r"[^\s\x1c-\x1f,/\-]"
_NUMBER = r"\d+(?:\.\d+)*"

# A contents row ends in a leader (tabs, two no-break spaces or two dots) and a page number.
CONTENTS_ROW = rf"(?U)(?:\t|\x{{a0}}{{2}}|\.{{2}}){_SPACE}*\d{{1,4}}{_SPACE}*$"
NUMBER_ONLY = rf"(?U)^\(?{_NUMBER}\)?\.?$"
NUMBERED = rf"(?U)^((?:Section{_SPACE}+|Article{_SPACE}+)?{_NUMBER})\.?{_SPACE}+[^\s\x1c-\x1f]"
NUMBERED_PREFIX = rf"(?U)^(?:Section{_SPACE}+|Article{_SPACE}+)?{_NUMBER}[. \t]*"
ARTICLE = rf"(?U)^(?i:ARTICLE){_SPACE}+(?i:[IVXLC\d]+)\b"
# One to eight words; the first and the last start with a capital, the ones between start with a
# capital or are connectors.
_CAPITALISED = rf"\p{{IsUppercase}}{_WORD}*"
TITLE = (
    rf"(?U)^{_GAP}*{_CAPITALISED}"
    rf"(?:(?:{_GAP}+(?:{_CAPITALISED}|(?i:{'|'.join(CONNECTORS)}))){{0,{MAX_TITLE_WORDS - 2}}}{_GAP}+{_CAPITALISED})?"
    rf"{_GAP}*$"
)

# Line shapes, the result of ``line_shape``.
BODY, TITLED, NUMBER, ARTICLE_ONLY, NUMBERED_LINE, NUMBERED_TITLED = range(6)


def is_plausible(line: Column) -> Column:
    """Short, not empty and not a contents row."""
    return F.length(line).between(1, MAX_HEADER_CHARS) & ~line.rlike(CONTENTS_ROW)


def is_all_caps(line: Column) -> Column:
    """Strictly more than 90 % of the letters are capitals (and there is a letter)."""
    letters = F.length(F.regexp_replace(line, r"\P{L}+", ""))
    capitals = F.length(F.regexp_replace(line, r"\P{Lu}+", ""))
    return capitals * 10 > letters * 9


def is_title(line: Column) -> Column:
    """Title case with lower-case connectors."""
    return line.rlike(TITLE)


def is_heading_text(line: Column) -> Column:
    """X4 or X5; the cheaper test first."""
    return is_title(line) | is_all_caps(line)


def is_number_only(line: Column) -> Column:
    """X7, first half: nothing but a section number."""
    return line.rlike(NUMBER_ONLY)


def is_numbered_heading(line: Column) -> Column:
    """A section number followed by heading text on the same line."""
    return line.rlike(NUMBERED) & is_heading_text(F.regexp_replace(line, NUMBERED_PREFIX, ""))


def is_article(line: Column) -> Column:
    """``ARTICLE`` and a roman or arabic number."""
    return line.rlike(ARTICLE)


def number_depth(token: Column) -> Column:
    """Dots between the numbers, plus one."""
    return F.length(F.regexp_replace(token, r"\.$|[^.]", "")) + 1


def numbered_depth(line: Column) -> Column:
    """X10 for a one-line numbered header."""
    return number_depth(F.regexp_extract(line, NUMBERED, 1))


def line_shape(line: Column) -> Column:
    """X3-X8 in one code per line, from which headers follow by looking at direct neighbours only.

    A number on its own never reads as a heading, so it can never be the title that the number
    before it consumes. That is why "a header starts here" depends on the line, the one before and
    the one after, and needs no scan from the top of the document.
    """
    numbered = is_numbered_heading(line)
    heading = is_heading_text(line)
    return (
        F.when(~is_plausible(line), BODY)
        .when(is_number_only(line), NUMBER)
        .when(numbered, F.when(heading, NUMBERED_TITLED).otherwise(NUMBERED_LINE))
        .when(heading, TITLED)
        .when(is_article(line), ARTICLE_ONLY)
        .otherwise(BODY)
    )


def is_title_shape(shape: Column) -> Column:
    """The line may serve as the title of a number on the line before."""
    return shape.isin(TITLED, NUMBERED_TITLED)


def starts_split_header(shape: Column, following: Column) -> Column:
    """A lone number whose title is the next line."""
    return (shape == NUMBER) & F.coalesce(is_title_shape(following), F.lit(False))


def starts_header(shape: Column, before: Column, following: Column) -> Column:
    """A header begins on this line."""
    taken = F.coalesce(before == NUMBER, F.lit(False)) & is_title_shape(shape)
    whole_line = shape.isin(TITLED, ARTICLE_ONLY, NUMBERED_LINE, NUMBERED_TITLED) & ~taken
    return whole_line | starts_split_header(shape, following)


def header_level(line: Column, shape: Column) -> Column:
    """X10 for a header that begins on this line; headers without a number are level 1."""
    return (
        F.when(shape == NUMBER, number_depth(line))
        .when(shape.isin(NUMBERED_LINE, NUMBERED_TITLED), numbered_depth(line))
        .otherwise(1)
    )
