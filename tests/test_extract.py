import random
import time

from pyspark.sql import functions as F

from clausemill.functions import headers as H
from clausemill.functions.taxonomy import CONTRACT_LABELS, CONTRACTS
from clausemill.operators import extract as X

# Lines by hand: (line, plausible header, all capitals, title, labels).
LINES = [
    ("Termination", True, False, True, ["Termination"]),
    ("TERMINATION", True, True, True, ["Termination"]),
    ("Governing Law", True, False, True, ["Governing Law"]),
    ("Law of the Land", True, False, True, []),
    ("Land of the", True, False, False, []),
    ("of Law", True, False, False, []),
    ("Ships sail East", True, False, False, []),
    ("One Two Three Four Five Six Seven Eight", True, False, True, []),
    ("One Two Three Four Five Six Seven Eight Nine", True, False, False, []),
    ("MILLS AND RIVERS x", True, True, False, []),
    ("MILLS x", True, False, False, []),
    ("ÜBER ÉTAT", True, True, True, []),
    ("Termination ..... 12", False, False, False, ["Termination"]),
    ("Warranty\t3", False, False, False, ["Warranty/Representations"]),
    ("Payment 7", True, False, False, ["Payment Terms"]),
    ("T" * 100, True, True, True, []),
    ("T" * 101, False, True, True, []),
    ("—", True, False, False, []),
    ("reassignment of mills", True, False, False, []),
]

# Documents by hand: lines, and the headers (start, title, text, level) that they hold.
BODY = "The parties agree to the terms that are set out in this section."
DOCUMENTS = [
    ([BODY, "Mills", BODY], [(1, 1, "Mills", 1)]),
    (["3.", "RIVER RIGHTS", BODY], [(0, 1, "RIVER RIGHTS", 1)]),
    (["(3.2)", "River Rights", BODY, "4.1.7", "no title here"], [(0, 1, "River Rights", 2)]),
    (["3.2 River Rights", BODY], [(0, 0, "3.2 River Rights", 2)]),
    (["Section 8 Grain", BODY], [(0, 0, "Section 8 Grain", 1)]),
    (["3.2 the grain is ground", BODY], []),
    (["ARTICLE IV the mill", "article of trade", BODY], [(0, 0, "ARTICLE IV the mill", 1)]),
    (["7", "Grain Stores \t12", BODY], []),
    ([], []),
]


def _lines_table(spark, documents):
    return spark.createDataFrame(list(enumerate(documents)), "doc int, lines array<string>").withColumn("error", F.lit(None).cast("string"))


def test_line_tests_by_hand(spark):
    line = F.col("line")
    got = spark.createDataFrame([(x[0],) for x in LINES], "line string").select(
        "line",
        H.is_plausible(line).alias("plausible"),
        H.is_all_caps(line).alias("caps"),
        H.is_title(line).alias("title"),
        CONTRACTS.all_labels(line).alias("labels"),
        CONTRACTS.first_label(line).alias("first"),
    )
    found = {r["line"]: r for r in got.collect()}
    for text, plausible, caps, title, labels in LINES:
        r = found[text]
        assert (r["plausible"], r["caps"], r["title"], r["first"]) == (plausible, caps, title, labels[0] if labels else None), r
        assert len(r["labels"]) == len(labels), r


def test_headers_by_hand(spark):
    rows = _lines_table(spark, [lines for lines, _ in DOCUMENTS])
    found = {}
    for r in X.header_rows(rows).collect():
        found.setdefault(r["doc"], []).append((r["start_idx"], r["title_idx"], r["header_text"], r["level"]))
    for doc, (_, expected) in enumerate(DOCUMENTS):
        assert sorted(found.get(doc, [])) == expected, doc


def _documents(count, seed):
    """Documents of titles, numbers, contents rows and bodies in any order."""
    rng = random.Random(seed)
    pieces = ["1.", "2.3", "(4.5.6)", "TERMINATION", "Termination", "Payment Terms", "3.1 Grain Assignment", "Warranty\t8", "the end", BODY, BODY + " " + BODY]
    return [[rng.choice(pieces) for _ in range(rng.randrange(40))] for _ in range(count)]


def test_sections_end_where_an_equal_or_higher_rank_begins(spark):
    documents = _documents(300, 7)
    rows = X.with_sections(X.with_headers(_lines_table(spark, documents))).select("doc", "headers", "sections").collect()
    seen = 0
    for r in rows:
        lines = documents[r["doc"]]
        rank = {h["start_idx"]: h["level"] for h in r["headers"]}
        for s in r["sections"]:
            seen += 1
            inside = [rank[i] for i in range(s["first_line"], s["end_line"]) if i in rank]
            assert all(level > s["level"] for level in inside)
            assert s["end_line"] == len(lines) or rank[s["end_line"]] <= s["level"]
    assert seen > 500


def test_kept_clauses_are_the_longest_of_their_header(spark):
    documents = _documents(300, 8)
    held = X.with_candidates(X.with_sections(X.with_headers(_lines_table(spark, documents))))
    rows = X.keep_longest(held).select("doc", "candidates", "clauses").collect()
    for r in rows:
        groups = {}
        for c in r["candidates"]:
            assert len(c["text"]) >= 30 and c["text"] == " ".join(c["text"].split(" ")).strip()
            groups.setdefault((c["label"], c["section_header"].lower().replace(" - ", "-")), []).append(c["text"])
        kept = sorted(r["clauses"], key=lambda c: c["seq"])
        assert len(kept) == len(groups)
        for c, (key, texts) in zip(kept, groups.items(), strict=True):
            assert (c["label"], c["text"]) == (key[0], max(texts, key=len))


def _filing(*lines):
    return "<DOCUMENT>\n<TYPE>EX-10\n<TEXT>\n<html><body>" + "".join(f"<p>{line}</p>" for line in lines) + "</body></html>"


def _extract(spark, raws):
    rows = spark.createDataFrame(list(enumerate(raws)), "doc int, raw string")
    got = X.extract(rows).orderBy("doc", "seq").collect()
    return [(r["doc"], r["label"], r["section_header"], r["text"]) for r in got if r["label"]], [r["doc"] for r in got if r["error"]]


def test_mini_filings(spark):
    clauses, failed = _extract(
        spark,
        [
            _filing("Short", "nothing here"),
            _filing("ARTICLE IX - CONFIDENTIAL RECIPES", "too short", "ARTICLE IX- CONFIDENTIAL RECIPES", BODY, BODY),
            _filing("4.2 Termination by the Miller", BODY),
            _filing("5", "TERMINATION", BODY, "5.1", "Payment After Termination", BODY, "6.", "NOTICES", BODY),
            _filing("CONFIDENTIAL", BODY),
            _filing("Termination......... 4", BODY),
            None,
        ],
    )
    assert clauses == [
        (1, "Confidentiality", "ARTICLE IX- CONFIDENTIAL RECIPES", f"{BODY}\n{BODY}"),
        (2, "Termination", "4.2 Termination by the Miller", BODY),
        (3, "Termination", "TERMINATION", f"{BODY}\n5.1\nPayment After Termination\n{BODY}"),
        (3, "Termination", "Payment After Termination", BODY),
        (4, "Confidentiality", "CONFIDENTIAL", BODY),
    ]
    assert failed == [6]


def test_labels_are_in_the_taxonomy(spark):
    clauses, _ = _extract(spark, [_filing(*lines) for lines in _documents(50, 3)])
    assert clauses and {c[1] for c in clauses} <= set(CONTRACT_LABELS)


def test_first_of_equal_length_stays(spark):
    first, second = "a" * 40, "b" * 40
    clauses, _ = _extract(spark, [_filing("Termination", first, "NOTICES", "Termination", second)])
    assert [c[3] for c in clauses] == [first]


def test_levels_are_not_limited(spark):
    lines = []
    for level in range(1, 40):
        lines += [".".join(["1"] * level), "Termination Rights", BODY]
    lines += ["1.1", "NOTICES", BODY]
    rows = spark.createDataFrame([(0, lines)], "doc int, lines array<string>").withColumn("error", F.lit(None).cast("string"))
    sections = X.with_sections(X.with_headers(rows)).select(F.inline("sections")).collect()
    assert max(s["level"] for s in sections) == 39
    assert [s["end_line"] for s in sections] == [len(lines)] + [39 * 3] * 38


def test_a_document_full_of_headers(spark):
    lines = [x for n in range(6000) for x in (f"TERMINATION {n}X", BODY)]
    rows = spark.createDataFrame([(0, lines)], "doc int, lines array<string>").withColumn("error", F.lit(None).cast("string"))
    started = time.time()
    assert X.with_clauses(rows).select(F.size("clauses").alias("n")).first()["n"] == 6000
    assert time.time() - started < 60


def test_only_completed_documents_are_kept(spark):
    documents = spark.createDataFrame(
        [("1", f"0000000001-2{n}-00000{n}", "x.htm", _filing("Termination", BODY) if n != 2 else None) for n in range(4)],
        "cik string, accession string, filename string, raw string",
    )
    manifest = spark.createDataFrame(
        [(f"0000000001-2{n}-00000{n}", "x.htm", "Co", None, "EX-10", "failed" if n == 1 else "done") for n in range(3)],
        "accession string, filename string, company string, form_type string, file_type string, status string",
    )
    found = X.extract_completed(documents, manifest)
    assert X.clause_corpus(found).collect()[0].asDict() == {
        "label": "Termination", "section_header": "Termination", "text": BODY, "cik": "1", "company": "Co", "form_type": None,
        "file_type": "EX-10", "accession": "0000000001-20-000000", "filename": "x.htm", "filing_year": "2020",
    }
    assert [r["accession"] for r in X.failed_documents(found).collect()] == ["0000000001-22-000002"]
