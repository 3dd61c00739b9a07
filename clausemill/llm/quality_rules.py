"""Line-first quality rules (operator 1), with DataFrame functions only.

Every line of a text is judged by three rules. Lines that break one are removed, and a document that loses
too much of its text with them is rejected.

* punctuation: no letter or digit; symbols or doubled marks as if every third word had one; a line of one or
  two words that ends without a mark;
* navigation: items between bars, arrows or dots with at most four words each; a menu phrase alone on its line;
* boilerplate: a short line with a stock phrase about cookies, scripts or rights.

Before that come base rules on the whole text: at least ``MIN_WORDS`` words, and at most half of the words
inside three-word windows that occur twice or more.

A null text counts as empty and, having no words, is rejected. A blank line breaks no rule. Each row is judged
by itself, so repeated rows and ids get equal verdicts and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.llm.common import GAP, WORD, let, whole, words

# Fixed values of the rules.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
MAX_LOST_PERCENT = 40
SYMBOLS = "#*$%&|<>"
MARKED_WORD = r"[#*$%&<>]+|[!?]{2,}"
SEPARATOR = r"[ \t](?:[|>•·»›]|::)[ \t]"
ENDS_WELL = r"[.!?…:;,\"'”’»)\]。！？][ \t\r]*$"
SIGN = r"[\p{L}\p{N}]"
MENU_LINE = (
    r"(?i)^[ \t]*(?:home|menu|log ?in|log ?out|sign (?:in|up)|register|search|next(?: page)?|prev(?:ious)?(?: page)?"
    r"|back(?: to top)?|share(?: this)?|read more|contact(?: us)?|about(?: us)?|skip to (?:main )?content|subscribe|sitemap)"
    r"[ \t.!:>»]*$"
)
STOCK_PHRASE = (
    r"(?i)lorem ipsum|(?:accept|uses?|using) (?:all |our |of )?cookies|cookie (?:policy|settings)|enable javascript"
    r"|javascript is (?:disabled|required)|all rights reserved|privacy policy|terms of (?:use|service)|terms and conditions"
)
STOCK_LINE_WORDS = 20
ITEM_WORDS = 4


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def _joined(text: Column) -> Column:
    """A text without its white space."""
    return F.regexp_replace(text, GAP, "")


def line_fails(line: Column) -> Column:
    """Whether a line breaks the punctuation, navigation or boilerplate rule."""

    def rules(n: Column) -> Column:
        separators = F.when(line.rlike(SEPARATOR), _count(line, SEPARATOR)).otherwise(0)
        punctuation = (
            ~line.rlike(SIGN) | (line.rlike(MARKED_WORD) & (_count(line, MARKED_WORD) * 3 >= n)) | ((n <= 2) & ~line.rlike(ENDS_WELL))
        )
        navigation = ((separators > 0) & (n - separators <= ITEM_WORDS * (separators + 1))) | ((n <= ITEM_WORDS) & line.rlike(MENU_LINE))
        boilerplate = (n <= STOCK_LINE_WORDS) & line.rlike(STOCK_PHRASE)
        return (n > 0) & (punctuation | navigation | boilerplate)

    return let(F.size(words(line)), rules)


def repeated_words(ws: Column) -> Column:
    """Words inside three-word windows that occur twice or more in an array of words.

    Windows are compared by a 64-bit hash; their positions are sorted by it, so equal windows are neighbours.
    """

    def covered(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, at: F.struct(h.alias("h"), at.alias("at"))))

        def in_groups(p: Column) -> Column:
            last = F.size(p) - 1
            again = F.filter(
                p,
                lambda x, j: ((j > 0) & (x["h"] == p[F.greatest(j - 1, F.lit(0))]["h"]))
                | ((j < last) & (x["h"] == p[F.least(j + 1, last)]["h"])),
            )
            return F.size(F.array_distinct(F.flatten(F.transform(again, lambda x: F.array(x["at"], x["at"] + 1, x["at"] + 2)))))

        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(let(placed, in_groups))

    def of(w: Column) -> Column:
        windows = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(w[i], w[i + 1], w[i + 2]))
        return F.when(F.size(w) < 4, 0).otherwise(let(windows, covered))

    return let(ws, of)


def judge(docs: DataFrame, text: str = "text") -> DataFrame:
    """Each row as ``row`` with its measures and verdict; input columns may have any other names.

    ``clean`` is the text without the failed lines.
    """
    rows = docs.select(F.struct("*").alias("row"), whole(text).alias("text"))
    lines = F.transform(
        F.split("text", "\n"),
        lambda line: F.struct(line.alias("line"), line_fails(line).alias("failed"), line.rlike(WORD).alias("has_word")),
    )
    rows = rows.select(
        "row",
        words(F.col("text")).alias("words"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    with_word = F.transform(F.filter("lines", lambda x: x["has_word"]), lambda x: x["line"])
    failed = F.filter("lines", lambda x: x["failed"])
    rows = rows.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        let(with_word, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size(failed).cast("long").alias("n_failed_lines"),
        F.length(_joined(F.array_join(F.transform(failed, lambda x: x["line"]), "\n"))).cast("long").alias("lost_chars"),
        F.array_join(F.transform(F.filter("lines", lambda x: ~x["failed"]), lambda x: x["line"]), "\n").alias("clean"),
    )
    rows = rows.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED_PERCENT),
    )
    lost = F.col("lost_chars") * 100 > F.col("word_chars") * MAX_LOST_PERCENT
    return rows.withColumn("kept", ~F.col("base_failed") & ~lost)


def clean(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The documents that are kept, without their failed lines, in the columns they came with.

    ``length`` names a column that holds the length of the text and is kept right; it may be missing.
    """
    # Filters are not moved below a generator that makes their columns; moved, they would judge every text twice.
    judged = judge(docs, text).select("row", F.inline_outer(F.array(F.struct("kept", "clean")))).where("kept")
    kinds = dict(docs.dtypes)
    out = []
    for name in docs.columns:
        if name == text:
            out.append(F.col("clean").alias(name))
        elif name == length:
            out.append(F.length("clean").cast(kinds[name]).alias(name))
        else:
            out.append(F.col("row")[name].alias(name))
    return judged.select(*out)
