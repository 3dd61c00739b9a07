"""Queries of the extraction step: lines, headers, sections, clauses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clausemill.catalog import star
from clausemill.catalog.registry import query
from clausemill.functions import headers as H
from clausemill.functions.ids import clause_id, filing_year, source_id
from clausemill.functions.taxonomy import CONTRACT_KEYWORDS, CONTRACTS, Taxonomy
from clausemill.functions.text import clean_spaces, exhibit_body
from clausemill.operators import extract as X
from clausemill.operators.profile import documents_scanned, frequency_gate, label_frequencies
from clausemill.session import scratch_path
from clausemill.sources.exhibits import read_exhibits, read_exhibits_anywhere, with_path_keys, write_exhibits

# A second taxonomy, for prose that carries licence lines instead of contract headers.
LICENCES = Taxonomy.of(
    ["Apache", "MIT", "GPL", "Creative Commons"],
    {
        "Apache": ["apache license"],
        "MIT": ["mit license"],
        "GPL": ["general public license", "gpl"],
        "Creative Commons": ["cc by", "creative commons"],
    },
)

# --- SQL counterparts -------------------------------------------------------------------------

_DOC_LINES = r"""
doc_lines AS (
  SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY j) - 1 AS INTEGER) AS i, trim(line) AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS j FROM documents)
  WHERE trim(line) <> '')"""

_GAP = r"[\s\x{a0},/\-]"
_WORD = r"[^\s\x{a0},/\-]"
_TITLE = (
    rf"^{_GAP}*\p{{Lu}}{_WORD}*"
    rf"(({_GAP}+(\p{{Lu}}{_WORD}*|(?i:of|on|in|for|and|to|the|a|an|or|by|with|from))){{0,6}}{_GAP}+\p{{Lu}}{_WORD}*)?{_GAP}*$"
)
_CAPS = r"length(regexp_replace({0}, '[^\p{{Lu}}]', '', 'g')) * 10 > length(regexp_replace({0}, '[^\p{{L}}]', '', 'g')) * 9"
_REST = r"regexp_replace(line, '^(Section[\s\x{a0}]+|Article[\s\x{a0}]+)?[0-9]+(\.[0-9]+)*[. \t]*', '')"


def _flags(lines: str) -> str:
    return rf"""
flags AS (
  SELECT doc_id, i, line,
         length(line) <= 100 AND NOT regexp_matches(line, '(\t|\x{{a0}}{{2}}|\.{{2}})[\s\x{{a0}}]*[0-9]{{1,4}}[\s\x{{a0}}]*$') AS plausible,
         {_CAPS.format("line")} AS caps,
         regexp_matches(line, '{_TITLE}') AS title,
         regexp_matches(line, '^\(?[0-9]+(\.[0-9]+)*\)?\.?$') AS number_only,
         regexp_matches(line, '^(Section[\s\x{{a0}}]+|Article[\s\x{{a0}}]+)?[0-9]+(\.[0-9]+)*\.?[\s\x{{a0}}]+[^\s\x{{a0}}]')
           AND ({_CAPS.format(_REST)} OR regexp_matches({_REST}, '{_TITLE}')) AS numbered,
         regexp_matches(line, '^(?i:ARTICLE)[\s\x{{a0}}]+(?i:[IVXLC0-9]+)\b') AS article
  FROM {lines})"""


_HEADERS = r"""
neighbours AS (
  SELECT *, plausible AND number_only AND coalesce(lead(plausible AND (caps OR title)) OVER w, false) AS split,
         lead(line) OVER w AS next_line
  FROM flags WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
located AS (SELECT *, coalesce(lag(split) OVER (PARTITION BY doc_id ORDER BY i), false) AS taken FROM neighbours),
headers AS (
  SELECT doc_id, i AS start_idx, CASE WHEN split THEN i + 1 ELSE i END AS title_idx,
         CASE WHEN split THEN next_line ELSE line END AS header_text,
         CAST(CASE WHEN split THEN length(regexp_replace(rtrim(line, '.'), '[^.]', '', 'g')) + 1
              WHEN numbered THEN length(regexp_replace(regexp_extract(line, '^(Section[\s\x{a0}]+|Article[\s\x{a0}]+)?([0-9]+(\.[0-9]+)*)', 2), '[^.]', '', 'g')) + 1
              ELSE 1 END AS INTEGER) AS level
  FROM located WHERE plausible AND NOT taken AND (split OR numbered OR caps OR title OR article))"""


def _sql_matches(column: str, keywords: list[str]) -> str:
    return rf"regexp_matches({column}, '(^|[^\p{{L}}\p{{N}}_])({'|'.join(keywords)})')"


def _sql_label(column: str, keywords: dict[str, list[str]]) -> str:
    return "CASE " + " ".join(f"WHEN {_sql_matches(column, words)} THEN '{label}'" for label, words in keywords.items()) + " END"


def _sql_label_count(column: str) -> str:
    return " + ".join(f"CAST({_sql_matches(column, words)} AS INTEGER)" for words in CONTRACT_KEYWORDS.values())


_SECTIONS = f"""
sections AS (
  SELECT h.doc_id, {_sql_label("lower(header_text)", CONTRACT_KEYWORDS)} AS label, header_text, level, title_idx + 1 AS first_line,
         start_idx,
         coalesce((SELECT min(l.start_idx) FROM headers l WHERE l.doc_id = h.doc_id AND l.start_idx > h.start_idx AND l.level <= h.level),
                  n.line_count) AS end_line
  FROM headers h JOIN (SELECT doc_id, count(*) AS line_count FROM lines GROUP BY doc_id) n ON n.doc_id = h.doc_id),
labelled AS (SELECT * FROM sections WHERE label IS NOT NULL)"""

_CANDIDATES = r"""
bodies AS (
  SELECT s.doc_id, s.start_idx, s.label,
         trim(regexp_replace(s.header_text, '[ \t\x{a0}]+', ' ', 'g')) AS section_header,
         trim(regexp_replace(coalesce(string_agg(l.line, chr(10) ORDER BY l.i), ''), '[ \t\x{a0}]+', ' ', 'g')) AS text
  FROM labelled s LEFT JOIN lines l ON l.doc_id = s.doc_id AND l.i >= s.first_line AND l.i < s.end_line
  GROUP BY ALL),
candidates AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY start_idx) AS place,
         regexp_replace(lower(section_header), '\s*-\s*', '-', 'g') AS key
  FROM bodies WHERE length(text) >= 30)"""

_FOUND = """
found AS (
  SELECT doc_id, CAST(min(place) OVER (PARTITION BY doc_id, label, key) AS INTEGER) AS seq, label, section_header, text
  FROM candidates
  QUALIFY row_number() OVER (PARTITION BY doc_id, label, key ORDER BY length(text) DESC, place) = 1)"""


def _with(*parts: str, select: str) -> str:
    return "," + ",".join(parts) + "\n" + select


# --- data --------------------------------------------------------------------------------------


def _document_lines(spark: SparkSession, folder: str) -> DataFrame:
    documents = star.spread(star.table(spark, folder, "documents"), "doc_id").select("doc_id", "text")
    return X.line_rows(X.with_plain_lines(documents))


def _exhibits_read(spark: SparkSession, folder: str) -> DataFrame:
    return X.with_lines(star.exhibits(spark, folder).select("doc_id", "raw"))


def _exhibit_lines(spark: SparkSession, folder: str) -> DataFrame:
    return X.line_rows(_exhibits_read(spark, folder))


# --- lines -------------------------------------------------------------------------------------


_FILE_LINES = """SELECT f.cik, f.accession, f.filename, md5(string_agg(line, chr(10) ORDER BY i)) AS lines_md5
FROM lines JOIN filings f ON doc_id = o_orderkey GROUP BY ALL"""


def _exhibit_files(spark: SparkSession, folder: str) -> str:
    """The rendered exhibits as files, one folder per company and filing."""
    place = scratch_path(spark, "exhibit-files")
    write_exhibits(star.exhibits(spark, folder), place)
    return place


def _lines_of_files(files: DataFrame) -> DataFrame:
    return X.with_lines(files).select("cik", "accession", "filename", F.md5(F.array_join("lines", "\n")).alias("lines_md5"))


@query("s1_exhibit_files", _FILE_LINES)
def exhibit_files(spark, folder):
    return _lines_of_files(read_exhibits(spark, _exhibit_files(spark, folder)))


@query("s3_exhibit_files_anywhere", _FILE_LINES)
def exhibit_files_anywhere(spark, folder):
    return _lines_of_files(with_path_keys(read_exhibits_anywhere(spark, _exhibit_files(spark, folder))))


@query(
    "s2_path_keys",
    "SELECT o_orderkey, cik, accession, filename FROM filings",
)
def path_keys(spark, folder):
    files = star.filings(spark, folder).select("o_orderkey", F.concat_ws("/", F.lit("file:/data/raw"), "cik", "accession", "filename").alias("path"))
    return with_path_keys(files).drop("path")


@query(
    "x1_exhibit_body",
    "SELECT doc_id, md5(CASE WHEN lang = 'de' THEN text ELSE chr(10) || text END) AS body FROM documents",
)
def body(spark, folder):
    start = F.when(F.col("lang") == "de", "").when(F.col("lang") == "es", "<document>\n<text>\n").otherwise("<DOCUMENT>\n<TYPE>EX-10\n<TEXT>\n")
    pages = star.table(spark, folder, "documents").select("doc_id", F.concat(start, "text").alias("raw"))
    return pages.select("doc_id", F.md5(exhibit_body(F.col("raw"))).alias("body"))


@query("x2_exhibit_lines", "SELECT doc_id, i, line FROM lines")
def exhibit_lines(spark, folder):
    return _exhibit_lines(spark, folder)


@query("x2_plain_lines", _with(_DOC_LINES, select="SELECT doc_id, i, line FROM doc_lines"))
def plain(spark, folder):
    return _document_lines(spark, folder)


@query(
    "x2_page_lines",
    r""", bare AS (
  SELECT page_id, regexp_replace(regexp_replace(html, '(?s)<script.*?</script>|<style.*?</style>|<!--.*?-->', chr(10), 'g'),
                                 '<[a-zA-Z/!][^>]*>', chr(10), 'g') AS text
  FROM pages),
decoded AS (
  SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(text, '&copy;', '©'), '&middot;', '·'), '&quot;', '"'),
                                 '&lt;', '<'), '&gt;', '>'), '&amp;?', '&', 'g') AS text
  FROM bare),
split_lines AS (
  SELECT page_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS j FROM decoded)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY j) - 1 AS INTEGER) AS i, trim(line) AS line
FROM split_lines WHERE trim(line) <> ''""",
)
def page_lines(spark, folder):
    pages = star.spread(star.table(spark, folder, "pages"), "page_id").select("page_id", "html")
    return X.line_rows(X.with_lines(pages, "html"))


# --- one line at a time ------------------------------------------------------------------------


@query(
    "x3_plausible_lines",
    _with(_flags("lines"), select="SELECT doc_id, i, plausible FROM flags"),
)
def plausible(spark, folder):
    return _exhibit_lines(spark, folder).select("doc_id", "i", H.is_plausible(F.col("line")).alias("plausible"))


@query("x4_all_caps_lines", _with(_DOC_LINES, _flags("doc_lines"), select="SELECT doc_id, i, caps FROM flags"))
def caps(spark, folder):
    return _document_lines(spark, folder).select("doc_id", "i", H.is_all_caps(F.col("line")).alias("caps"))


@query("x5_title_lines", _with(_DOC_LINES, _flags("doc_lines"), select="SELECT doc_id, i, title FROM flags"))
def titles(spark, folder):
    return _document_lines(spark, folder).select("doc_id", "i", H.is_title(F.col("line")).alias("title"))


@query("x6_numbered_headers", _with(_flags("lines"), select="SELECT doc_id, i, line FROM flags WHERE numbered"))
def numbered(spark, folder):
    return _exhibit_lines(spark, folder).where(H.is_numbered_heading(F.col("line")))


@query(
    "x7_split_headers",
    _with(_flags("lines"), _HEADERS, select="SELECT doc_id, start_idx, header_text, level FROM headers WHERE title_idx > start_idx"),
)
def split_headers(spark, folder):
    found = X.header_rows(_exhibits_read(spark, folder)).where(F.col("title_idx") > F.col("start_idx"))
    return found.select("doc_id", "start_idx", "header_text", "level")


@query(
    "x8_unnumbered_headers",
    _with(_DOC_LINES, _flags("doc_lines"), select="SELECT doc_id, i, line FROM flags WHERE plausible AND (caps OR article OR title)"),
)
def unnumbered(spark, folder):
    line = F.col("line")
    return _document_lines(spark, folder).where(H.is_plausible(line) & (H.is_heading_text(line) | H.is_article(line)))


@query(
    "x9_headers",
    _with(_flags("lines"), _HEADERS, select="SELECT doc_id, start_idx, title_idx, header_text, level FROM headers"),
)
def headers(spark, folder):
    return X.header_rows(_exhibits_read(spark, folder))


@query(
    "x9_document_headers",
    _with(_DOC_LINES, _flags("doc_lines"), _HEADERS, select="SELECT doc_id, start_idx, title_idx, header_text, level FROM headers"),
)
def document_headers(spark, folder):
    return X.header_rows(X.with_plain_lines(star.spread(star.table(spark, folder, "documents"), "doc_id").select("doc_id", "text")))


@query(
    "x10_headers_per_level",
    _with(_flags("lines"), _HEADERS, select="SELECT level, count(*) AS n FROM headers GROUP BY level"),
)
def levels(spark, folder):
    return X.header_rows(_exhibits_read(spark, folder)).groupBy("level").agg(F.count("*").alias("n"))


@query(
    "w1_next_and_previous_line",
    _with(
        _DOC_LINES,
        select="SELECT doc_id, i, lag(length(line)) OVER w AS before, lead(length(line)) OVER w AS after "
        "FROM doc_lines WINDOW w AS (PARTITION BY doc_id ORDER BY i)",
    ),
)
def neighbours(spark, folder):
    read = X.with_plain_lines(star.spread(star.table(spark, folder, "documents"), "doc_id").select("doc_id", "text"))
    lengths = read.select("doc_id", F.transform("lines", F.length).alias("lengths"))
    around = F.transform(
        "lengths",
        lambda _, i: F.struct(i.alias("i"), F.get("lengths", i - 1).alias("before"), F.get("lengths", i + 1).alias("after")),
    )
    return X.array_rows(lengths, around, "i", "doc_id")


# --- headers to clauses ------------------------------------------------------------------------


@query(
    "x11_first_label",
    _with(
        _flags("lines"),
        _HEADERS,
        select=f"SELECT doc_id, start_idx, {_sql_label('lower(header_text)', CONTRACT_KEYWORDS)} AS label FROM headers",
    ),
)
def first_label(spark, folder):
    found = X.header_rows(_exhibits_read(spark, folder))
    return found.select("doc_id", "start_idx", CONTRACTS.first_label(F.col("header_text")).alias("label"))


@query(
    "x11_licence_lines",
    _with(
        _DOC_LINES,
        ", ".join(
            [
                " licensed AS (SELECT doc_id, i, "
                + _sql_label("lower(line)", {label: list(words) for label, words in LICENCES.rules})
                + " AS label FROM doc_lines)"
            ]
        ),
        select="SELECT doc_id, i, label FROM licensed WHERE label IS NOT NULL",
    ),
)
def licence_lines(spark, folder):
    lines = _document_lines(spark, folder)
    return lines.select("doc_id", "i", LICENCES.first_label(F.col("line")).alias("label")).where(F.col("label").isNotNull())


@query(
    "x12_section_extents",
    _with(_flags("lines"), _HEADERS, _SECTIONS, select="SELECT doc_id, label, level, first_line, end_line FROM labelled"),
)
def extents(spark, folder):
    found = X.with_sections(X.with_headers(_exhibits_read(spark, folder)))
    return X.array_rows(found, "sections", "label", "doc_id").drop("header_text")


@query(
    "w2_header_extents",
    _with(_flags("lines"), _HEADERS, _SECTIONS, select="SELECT doc_id, start_idx, end_line FROM sections"),
)
def header_extents(spark, folder):
    found = X.with_headers(_exhibits_read(spark, folder)).withColumn("ends", X._extent_ends(F.col("headers"), F.size("lines")))
    pairs = F.zip_with("headers", "ends", lambda h, end: F.struct(h["start_idx"].alias("start_idx"), end.alias("end_line")))
    return X.array_rows(found, pairs, "start_idx", "doc_id")


def _candidates(spark: SparkSession, folder: str, min_chars: int = X.MIN_CLAUSE_CHARS) -> DataFrame:
    return X.with_candidates(X.with_sections(X.with_headers(_exhibits_read(spark, folder))), min_chars)


@query(
    "x13_section_bodies",
    _with(
        _flags("lines"), _HEADERS, _SECTIONS, _CANDIDATES, select="SELECT doc_id, label, section_header, md5(text) AS text_md5 FROM bodies"
    ),
)
def bodies(spark, folder):
    found = _candidates(spark, folder, 0)
    return X.array_rows(found, "candidates", "label", "doc_id").select("doc_id", "label", "section_header", F.md5("text").alias("text_md5"))


@query(
    "x14_minimum_length",
    _with(
        _flags("lines"),
        _HEADERS,
        _SECTIONS,
        _CANDIDATES,
        select="SELECT doc_id, label, section_header, CAST(length(text) AS INTEGER) AS text_len FROM candidates",
    ),
)
def long_enough(spark, folder):
    found = X.array_rows(_candidates(spark, folder), "candidates", "label", "doc_id")
    return found.select("doc_id", "label", "section_header", F.length("text").alias("text_len"))


_CLAUSES_SQL = _with(_flags("lines"), _HEADERS, _SECTIONS, _CANDIDATES, _FOUND, select="{select}")


@query(
    "x15_keep_longest",
    _CLAUSES_SQL.replace("{select}", "SELECT doc_id, seq, label, section_header, CAST(length(text) AS INTEGER) AS text_len FROM found"),
)
def longest(spark, folder):
    found = X.array_rows(X.keep_longest(_candidates(spark, folder)), "clauses", "seq", "doc_id")
    return found.select("doc_id", "seq", "label", "section_header", F.length("text").alias("text_len"))


@query("x16_clauses", _CLAUSES_SQL.replace("{select}", "SELECT doc_id, seq, label, section_header, text FROM found"))
def document_clauses(spark, folder):
    rows = X.extract(star.exhibits(spark, folder).select("doc_id", "raw"))
    return rows.select("doc_id", "seq", "label", "section_header", "text")


@query(
    "x17_failed_documents",
    "SELECT cik, accession, filename, 'TypeError' AS error_type FROM documents JOIN filings ON doc_id = o_orderkey WHERE o_orderstatus = 'P'",
)
def failed(spark, folder):
    unreadable = star.filings(spark, folder).select("accession", (F.col("o_orderstatus") == "P").alias("lost"))
    pages = star.exhibits(spark, folder).join(unreadable, "accession").withColumn("raw", F.when(~F.col("lost"), F.col("raw")))
    found = X.failed_documents(X.extract(pages.select("cik", "accession", "filename", "raw")))
    return found.select("cik", "accession", "filename", F.substring_index("error", ":", 1).alias("error_type"))


@query(
    "x18_all_labels",
    _with(
        _flags("lines"),
        _HEADERS,
        select=f"SELECT doc_id, start_idx, CAST({_sql_label_count('lower(header_text)')} AS INTEGER) AS n, "
        "concat_ws('; ', "
        + ", ".join(f"CASE WHEN {_sql_matches('lower(header_text)', words)} THEN '{label}' END" for label, words in CONTRACT_KEYWORDS.items())
        + ") AS labels FROM headers",
    ),
)
def all_labels(spark, folder):
    found = X.header_rows(_exhibits_read(spark, folder)).withColumn("all", CONTRACTS.all_labels(F.col("header_text")))
    return found.select("doc_id", "start_idx", F.size("all").alias("n"), F.array_join("all", "; ").alias("labels"))


@query("x19_source_id", "SELECT o_orderkey, accession || '/' || filename AS source_id FROM filings")
def sources(spark, folder):
    return star.filings(spark, folder).select("o_orderkey", source_id(F.col("accession"), F.col("filename")).alias("source_id"))


@query(
    "x20_filing_year",
    """SELECT o_orderkey, CASE WHEN regexp_full_match(accession, '[^-]*-[0-9][0-9]-[^-]*')
                               THEN '20' || split_part(accession, '-', 2) END AS filing_year FROM filings""",
)
def years(spark, folder):
    return star.filings(spark, folder).select("o_orderkey", filing_year(F.col("accession")).alias("filing_year"))


# --- corpus ------------------------------------------------------------------------------------

_CORPUS = """
corpus AS (
  SELECT f.label, f.section_header, f.text, m.cik, m.company, m.form_type, m.file_type, m.accession, m.filename,
         CASE WHEN regexp_full_match(m.accession, '[^-]*-[0-9][0-9]-[^-]*') THEN '20' || split_part(m.accession, '-', 2) END AS filing_year
  FROM found f JOIN filings ON doc_id = o_orderkey JOIN manifest m USING (accession, filename) WHERE m.status = 'done')"""


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    """The clause corpus of the rendered exhibits whose filings are completed."""
    documents = star.exhibits(spark, folder).drop("doc_id")
    return X.clause_corpus(X.extract_completed(documents, star.manifest(spark, folder)))


@query(
    "j1_completed_documents",
    "SELECT doc_id, m.company, m.form_type, m.file_type FROM documents JOIN filings f ON doc_id = o_orderkey "
    "JOIN manifest m USING (accession, filename) WHERE m.status = 'done'",
)
def completed_documents(spark, folder):
    documents = star.exhibits(spark, folder).select("doc_id", "accession", "filename")
    return documents.join(X.completed(star.manifest(spark, folder)), ["accession", "filename"]).select("doc_id", "company", "form_type", "file_type")


@query(
    "j1_completed_files",
    _with(
        _flags("lines"), _HEADERS, _SECTIONS, _CANDIDATES, _FOUND, _CORPUS,
        select="SELECT label, section_header, md5(text) AS text, cik, accession, filename, company FROM corpus",
    ),
)
def completed_files(spark, folder):
    """The clauses of exhibit files, of which only the completed ones are opened."""
    found = X.extract_listed(spark, _exhibit_files(spark, folder), star.manifest(spark, folder))
    return X.clause_corpus(found).select("label", "section_header", F.md5("text").alias("text"), "cik", "accession", "filename", "company")


@query(
    "p1_clause_corpus",
    _with(_flags("lines"), _HEADERS, _SECTIONS, _CANDIDATES, _FOUND, _CORPUS, select="SELECT * FROM corpus"),
)
def clause_corpus(spark, folder):
    return corpus(spark, folder)


@query(
    "k3_clause_id",
    _with(
        _flags("lines"),
        _HEADERS,
        _SECTIONS,
        _CANDIDATES,
        _FOUND,
        _CORPUS,
        select="SELECT sha1(accession || ':' || filename || ':' || label || ':' || section_header) AS clause_id, label FROM corpus",
    ),
)
def clause_ids(spark, folder):
    return corpus(spark, folder).select(clause_id().alias("clause_id"), "label")


_FREQUENCIES = """
tally AS (
  SELECT t.ord, t.label, count(f.label) AS n
  FROM (SELECT unnest({labels}) AS label, unnest(range(10)) AS ord) t LEFT JOIN found f ON f.label = t.label GROUP BY t.ord, t.label)""".replace(
    "{labels}", star._sql_list(star.CONTRACT_LABELS)
)


def _extracted(spark: SparkSession, folder: str) -> DataFrame:
    return X.with_clauses(_exhibits_read(spark, folder))


@query(
    "a4_all_label_counts",
    _with(
        _flags("lines"),
        _HEADERS,
        _SECTIONS,
        _CANDIDATES,
        _FOUND,
        _FREQUENCIES,
        select="SELECT CAST(ord AS INTEGER) AS ord, label, n, 100.0::DOUBLE * n / sum(n) OVER () AS pct FROM tally",
    ),
)
def all_label_counts(spark, folder):
    return label_frequencies(X.array_rows(_extracted(spark, folder), "clauses", "seq"))


@query(
    "a5_frequency_gate",
    _with(
        _flags("lines"),
        _HEADERS,
        _SECTIONS,
        _CANDIDATES,
        _FOUND,
        _FREQUENCIES,
        select="SELECT CASE WHEN min(n) = 0 THEN 'FAIL' ELSE 'PASS' END AS verdict, "
        "coalesce(string_agg(label, ', ' ORDER BY ord) FILTER (WHERE n = 0), '') AS missing FROM tally",
    ),
)
def gate(spark, folder):
    return frequency_gate(label_frequencies(X.array_rows(_extracted(spark, folder), "clauses", "seq")))


@query(
    "a5_frequency_gate_licences",
    _with(
        _DOC_LINES,
        " licensed AS (SELECT "
        + _sql_label("lower(line)", {label: list(words) for label, words in LICENCES.rules})
        + " AS label FROM doc_lines)",
        f" tally AS (SELECT t.ord, t.label, count(f.label) AS n FROM (SELECT unnest({star._sql_list(list(LICENCES.labels))}) AS label, "
        "unnest(range(4)) AS ord) t LEFT JOIN licensed f ON f.label = t.label GROUP BY t.ord, t.label)",
        select="SELECT CASE WHEN min(n) = 0 THEN 'FAIL' ELSE 'PASS' END AS verdict, "
        "coalesce(string_agg(label, ', ' ORDER BY ord) FILTER (WHERE n = 0), '') AS missing FROM tally",
    ),
)
def licence_gate(spark, folder):
    labels = _document_lines(spark, folder).select(LICENCES.first_label(F.col("line")).alias("label"))
    return frequency_gate(label_frequencies(labels, LICENCES))


@query(
    "a27_documents_scanned",
    _with(
        _flags("lines"),
        _HEADERS,
        _SECTIONS,
        _CANDIDATES,
        _FOUND,
        select="SELECT (SELECT count(*) FROM documents JOIN filings ON doc_id = o_orderkey) AS documents, "
        "(SELECT count(*) FROM documents JOIN filings ON doc_id = o_orderkey WHERE doc_id NOT IN (SELECT doc_id FROM found)) AS without_clauses, "
        "(SELECT count(*) FROM found) AS clauses",
    ),
)
def scanned(spark, folder):
    return documents_scanned(_extracted(spark, folder))


@query(
    "f1_clean_headers",
    _with(
        _flags("lines"),
        _HEADERS,
        select=r"SELECT doc_id, start_idx, trim(regexp_replace(header_text, '[ \t\x{a0}]+', ' ', 'g')) AS header FROM headers",
    ),
)
def clean_headers(spark, folder):
    return X.header_rows(_exhibits_read(spark, folder)).select("doc_id", "start_idx", clean_spaces(F.col("header_text")).alias("header"))
