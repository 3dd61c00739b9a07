"""Spelling variant grouping by PartEnum signatures (operator 12), with DataFrame functions only.

Two words are near if one inserted, deleted or replaced code point makes them equal. Seen as a multiset, a word is a
binary vector over (letter, which occurrence of it). Near words of one length differ in two places of that vector,
near words of neighbouring lengths in one. The places are dealt into parts by a fixed rule; a pair that differs in k
places agrees in all but k parts, so for every choice of (parts - k) parts a word has a signature of its letters there
(partition and enumerate): near words share one, and no pair is lost. As the one edit lies in one half of a word, the
other half is equal as it stands; signatures hold it as well, once for each half, so few other words share them.

Signatures meet in an equi-join of distinct words, whose size follows the vocabulary and not the text; pairs are
verified inside the join, and only near ones leave it. Large groups of equal signatures are split by the engine's
skewed-join handling. Words get numbers in code-point order first, so pairs travel as numbers.

A word's form is its near word of greatest count, if that count is at least ``ratio`` times its own; counts grow by
that ratio along forms, so roots are found by a few rounds of jumping. A word has at most some thousands of near
words (places times letters), so groups of pairs by word are bounded.

Null texts and ids: a null text has no words; with a null id no letter is deleted. Repeated rows count as often as they
occur. An empty table gives no words.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clausemill.llm.common import let, stored, whole

# What a word is made of, and which words take part.
NOT_LETTERS = r"[^A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
SLIP = 31  # of so many occurrences one loses a letter

EQUAL_PARTS = 4  # parts for words of one length, which differ in two places
OTHER_PARTS = 2  # parts for words of neighbouring lengths, which differ in one
MAX_ROUNDS = 20  # counts are below 10^19, and jumps double


def counts(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", slip: int | None = SLIP) -> DataFrame:
    """``word`` and ``n`` of every word with letters and occurrences enough.

    With ``slip``, an occurrence whose checksum with its document's id is divisible by it loses one letter, chosen by
    the checksum as well. Such a loss never makes a word long enough, so short runs are left out at once.
    """
    rows = docs.select(F.col(doc_id).cast("string").alias("id"), F.split(whole(text), NOT_LETTERS).alias("runs"))
    runs = rows.select("id", F.explode(F.filter("runs", lambda r: F.length(r) >= MIN_LETTERS)).alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    word = F.col("run")
    if slip is not None:
        mark = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))

        def slipped(h: Column) -> Column:
            at = (h % F.length("run")).cast("int")
            less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
            return F.when(h % slip == 0, less).otherwise(F.col("run"))

        word = let(mark, slipped)
    words = runs.select(word.alias("word")).where(F.length("word") >= MIN_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_COUNT)


def _dealt(word: Column, parts: int) -> Column:
    """A word's letters by part, each part as a string of its letters in order."""

    def of(letters: Column) -> Column:
        # A letter's first place among the sorted letters tells which occurrence of it each one is.
        placed = F.transform(
            letters,
            lambda c, at: F.struct(c.alias("c"), ((F.ascii(c) + 7 * (at - F.array_position(letters, c).cast("int") + 1)) % parts).alias("part")),
        )

        def string(p: Column, k: int) -> Column:
            return F.array_join(F.transform(F.filter(p, lambda x: x["part"] == k), lambda x: x["c"]), "")

        def strings(p: Column) -> Column:
            return F.array(*[string(p, k) for k in range(parts)])

        return let(placed, strings)

    return let(F.sort_array(F.split(word, "")), of)


def signatures(words: DataFrame) -> DataFrame:
    """``signature, role`` and the columns of ``words``: role 0 meets role 0 (equal lengths), 1 (shorter) meets 2."""
    word, size = F.col("word"), F.length("word")
    rows = words.withColumns({"_equal": _dealt(word, EQUAL_PARTS), "_other": _dealt(word, OTHER_PARTS)})
    made: list[Column] = []

    def halves(kind: int, role: int, dealt: str, parts: int, differ: int, short: Column) -> None:
        half = F.floor(short / 2).cast("int")
        ends = (F.substring(word, F.lit(1), half), F.right(word, short - half))
        for number, chosen in enumerate(combinations(range(parts), parts - differ)):
            letters = [F.get(F.col(dealt), F.lit(k)) for k in chosen]
            for which, end in enumerate(ends):
                place = F.lit((kind * 64 + number) * 2 + which)
                made.append(F.struct(F.xxhash64(place, short, end, *letters).alias("signature"), F.lit(role).alias("role")))

    halves(0, 0, "_equal", EQUAL_PARTS, 2, size)
    halves(1, 1, "_other", OTHER_PARTS, 1, size)
    halves(1, 2, "_other", OTHER_PARTS, 1, size - 1)
    return rows.select(F.inline(F.array(*made)), *words.columns)


def near_pairs(words: DataFrame) -> DataFrame:
    """Both directions of every near pair of numbered words (``id, word, n``): ``id, other, other_n``, some repeated."""
    signed = signatures(words)
    a, b = signed.alias("a"), signed.alias("b")
    # One expression of both roles: two conditions would filter the sides apart, and signatures would be made twice.
    roles = F.col("a.role") * 3 + F.col("b.role")
    meet = (F.col("a.signature") == F.col("b.signature")) & (((roles == 0) & (F.col("a.id") < F.col("b.id"))) | (roles == 5))
    near = F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1
    ends = [
        F.struct(F.col(f"{x}.id").alias("id"), F.col(f"{y}.id").alias("other"), F.col(f"{y}.n").alias("other_n")) for x, y in ("ab", "ba")
    ]
    return a.join(b, meet & near).select(F.inline(F.array(*ends)))


def group(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of distinct words with their counts ``n``."""
    spark = words.sparkSession
    numbered = words.select("word", "n").orderBy("word").withColumn("id", F.monotonically_increasing_id())
    numbered = stored(spark, numbered, "words")
    pairs = near_pairs(numbered).repartition("id").distinct()
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")))
    found = pairs.groupBy("id").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = stored(spark, found.select("id", "n_near", "best.other", (-F.col("best.less")).alias("other_n")), "near-words")
    known = numbered.join(found, "id", "left").withColumn("has_form", F.col("other_n") >= ratio * F.col("n"))
    known = stored(
        spark,
        known.select(
            "id",
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(F.col("has_form"), F.col("other")).alias("form_id"),
            F.when(F.col("has_form"), F.col("other_n")).alias("form_n"),
        ),
        "forms",
    )
    # Only words with a form move; a root is where the jumps end.
    steps = stored(spark, known.where("form_id IS NOT NULL").select("id", F.col("form_id").alias("root_id")), "roots")
    for _ in range(MAX_ROUNDS):
        onward = steps.select(F.col("id").alias("root_id"), F.col("root_id").alias("beyond"))
        jumped = steps.join(onward, "root_id", "left")
        jumped = stored(spark, jumped.select("id", F.coalesce("beyond", "root_id").alias("root_id"), F.col("beyond").isNotNull().alias("moved")), "roots")
        steps = jumped.select("id", "root_id")
        if jumped.where("moved").isEmpty():
            break
    else:
        raise RuntimeError(f"forms did not end in {MAX_ROUNDS} rounds")
    names = numbered.select("id", "word")
    form = names.select(F.col("id").alias("form_id"), F.col("word").alias("form"))
    root = names.select(F.col("id").alias("root_id"), F.col("word").alias("root"))
    moving = known.where("form_id IS NOT NULL").join(steps, "id").join(form, "form_id").join(root, "root_id")
    still = known.where("form_id IS NULL").select("word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n")
    return moving.select("word", "form", "root", "n", "n_near", "form_n").unionByName(still)
