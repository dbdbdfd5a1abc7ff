"""Readers (A1-A4, A12) and sinks."""

from tablewise.sources.readers import (jdbc_options, preview, read_csv, read_jdbc,  # noqa: F401
                                       read_path, write_csv)
from tablewise.sources.sinks import (append_metrics, exposition_lines,  # noqa: F401
                                     ml_exposition, profile_exposition, suggestions_by_column,
                                     suggestions_document, write_json_lines, write_lines)
