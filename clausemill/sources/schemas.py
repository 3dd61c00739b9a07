"""Declared schemas. Keys such as ``cik`` are strings wherever they come from."""

from __future__ import annotations

CLAUSES = (
    "label string not null, section_header string not null, text string not null, cik string not null, "
    "company string, form_type string, file_type string, accession string not null, filename string not null, "
    "filing_year string"
)
ENRICHED = (
    "clause_id string, label string, section_header string, text string, cik string, company string, "
    "form_type string, file_type string, accession string, filename string, filing_date date, "
    "filing_year string, sic string, sic_description string, text_len int"
)
CANDIDATES = ENRICHED + ", ambiguity_score int"
MANIFEST = (
    "accession string, filename string, cik string, company string, form_type string, file_type string, "
    "status string, downloaded_at timestamp"
)
COMPANIES = "cik string, sic string, sic_description string"
FILING_DATES = "cik string, accession string, filing_date date"
ASSIGNMENTS = "cik string, bucket string"
SUBMISSIONS = (
    "sic string, sicDescription string, "
    "filings struct<recent: struct<accessionNumber: array<string>, filingDate: array<string>>>"
)
