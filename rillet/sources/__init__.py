"""Sources: file scans (CSV, JSON, multi-path fan-in) and JSON/HTML reshaping."""
