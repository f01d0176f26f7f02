"""Sources and sinks: dump scan (S1-S3) and the versioned table store."""

from quire.sources.dumps import DumpNotFound, find_dump, read_dump_lines, scan_dump, split_rows  # noqa: F401
from quire.sources.store import TableStore  # noqa: F401
