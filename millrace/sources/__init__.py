from millrace.sources.files import scan_csv, scan_text
from millrace.sources.formats import FormatSpec
from millrace.sources.schemas import pin_schema, struct_from_columns
from millrace.sources.streams import stream_changes, stream_files, stream_table

__all__ = [
    "FormatSpec",
    "pin_schema",
    "scan_csv",
    "scan_text",
    "stream_changes",
    "stream_files",
    "stream_table",
    "struct_from_columns",
]
