from tabwright.sources.kept import kept_profile, profile_lines, top_lines
from tabwright.sources.lines import file_list, first_line, line_table, manifest_entries, read_lines, read_manifest
from tabwright.sources.records import parse_lines, read_records
from tabwright.sources.sinks import normalize_header, write_chunks, write_lines, write_records, write_rejects

__all__ = [
    "kept_profile", "profile_lines", "top_lines", "file_list", "first_line", "line_table", "manifest_entries", "read_lines", "read_manifest",
    "parse_lines", "read_records",
    "normalize_header", "write_chunks", "write_lines", "write_records", "write_rejects",
]
