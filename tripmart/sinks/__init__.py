"""Report files: one CSV and one Markdown output per question."""

from tripmart.sinks.reports import ReportStatus, markdown_lines, markdown_row, write_csv_files, write_report

__all__ = ["ReportStatus", "markdown_lines", "markdown_row", "write_csv_files", "write_report"]
