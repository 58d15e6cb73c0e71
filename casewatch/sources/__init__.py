"""Scans and sinks."""

from casewatch.sources.quarantine import RawScan, read_raw_checked
from casewatch.sources.raw import normalize_headers, read_raw, require_columns
from casewatch.sources.sinks import (
    read_evidence_json,
    read_evidence_text,
    read_tables,
    write_audit,
    write_counters,
    write_evidence_json,
    write_report,
    write_tables,
)

__all__ = [
    "RawScan",
    "read_raw_checked",
    "normalize_headers",
    "read_evidence_json",
    "read_evidence_text",
    "read_raw",
    "read_tables",
    "require_columns",
    "write_audit",
    "write_counters",
    "write_evidence_json",
    "write_report",
    "write_tables",
]
