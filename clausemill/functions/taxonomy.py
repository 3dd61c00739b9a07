"""The clause taxonomy as configuration and as column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The ten category names in reporting order.
CONTRACT_LABELS = [
    "Indemnification",
    "Limitation of Liability",
    "Termination",
    "Governing Law",
    "Confidentiality",
    "Assignment",
    "Force Majeure",
    "Payment Terms",
    "Warranty/Representations",
    "Dispute Resolution/Arbitration",
]

# Label -> header keywords, in the order in which the labels are tried.
CONTRACT_KEYWORDS = {
    "Limitation of Liability": [
        "limitation of liability",
        "limitation on liability",
        "limitations of liability",
        "limitations on liability",
        "limit of liability",
        "liability limitation",
    ],
    "Dispute Resolution/Arbitration": ["arbitrat", "dispute resolution"],
    "Governing Law": ["governing law", "choice of law", "applicable law"],
    "Force Majeure": ["force majeure"],
    "Confidentiality": ["confidential", "non-disclosure", "nondisclosure"],
    "Indemnification": ["indemnif"],
    "Termination": ["terminat"],
    "Assignment": ["assignment", "assign"],
    "Payment Terms": ["payment"],
    "Warranty/Representations": ["warrant", "representation"],
}


def keyword_pattern(keywords: list[str]) -> str:
    """One alternation that finds any of the keywords at the start of a word.

    The character before a keyword may not be a letter, a number or an underscore. Written with
    a consuming group rather than ``\\b`` so that it means the same in every regex dialect.
    """
    return r"(^|[^\p{L}\p{N}_])(" + "|".join(re.escape(k) for k in keywords) + ")"


@dataclass(frozen=True)
class Taxonomy:
    """Labels in reporting order and keyword rules in matching order."""

    labels: tuple[str, ...]
    rules: tuple[tuple[str, tuple[str, ...]], ...]

    @classmethod
    def of(cls, labels: list[str], keywords: dict[str, list[str]]) -> "Taxonomy":
        unknown = [label for label in keywords if label not in labels]
        if unknown:
            raise ValueError(f"keyword rules for labels outside the taxonomy: {unknown}")
        return cls(tuple(labels), tuple((label, tuple(words)) for label, words in keywords.items()))

    def first_label(self, header: Column) -> Column:
        """X11: the first rule whose keywords occur in the lower-cased header, else NULL.

        Most headers match nothing, so one alternation over all keywords is asked first.
        """
        lowered = F.lower(header)
        every_keyword = [word for _, words in self.rules for word in words]
        tried = reduce(
            lambda chain, rule: chain.when(lowered.rlike(keyword_pattern(rule[1])), F.lit(rule[0])),
            self.rules,
            F.when(~lowered.rlike(keyword_pattern(every_keyword)), F.lit(None).cast("string")),
        )
        return tried

    def all_labels(self, header: Column) -> Column:
        """Every label with a keyword in the header, in rule order."""
        lowered = F.lower(header)
        hits = [F.when(lowered.rlike(keyword_pattern(words)), F.lit(label)) for label, words in self.rules]
        return F.array_compact(F.array(*hits))

    def label_count(self, header: Column) -> Column:
        """How many labels the header matches; a sum of flags, so no array is built."""
        lowered = F.lower(header)
        return reduce(
            lambda a, b: a + b, (lowered.rlike(keyword_pattern(words)).cast("int") for _, words in self.rules)
        )

    def position(self, label: Column) -> Column:
        """0-based place of a label in reporting order; -1 when unknown."""
        return (F.array_position(F.array(*map(F.lit, self.labels)), label) - 1).cast("int")

    def table(self, spark: SparkSession) -> DataFrame:
        """``(ord, label, keywords)`` with one row per label."""
        words = dict(self.rules)
        rows = [
            F.struct(
                F.lit(i).alias("ord"),
                F.lit(label).alias("label"),
                F.array(*map(F.lit, words.get(label, ()))).cast("array<string>").alias("keywords"),
            )
            for i, label in enumerate(self.labels)
        ]
        return spark.range(1).select(F.inline(F.array(*rows)))


CONTRACTS = Taxonomy.of(CONTRACT_LABELS, CONTRACT_KEYWORDS)
