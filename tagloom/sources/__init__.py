from tagloom.sources.archive import read_archive_records
from tagloom.sources.heads import Layout, layout
from tagloom.sources.packed import read_packed_records
from tagloom.sources.splittable import read_records
from tagloom.sources.whole import read_whole_rows

__all__ = ["Layout", "layout", "read_archive_records", "read_packed_records", "read_records", "read_whole_rows"]
