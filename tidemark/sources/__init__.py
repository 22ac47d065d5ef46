from .caching import kept
from .delimited import read_header_csv, read_numeric_csv, split_columns, split_first_tab
from .lines import read_lines, read_word_list, write_lines
from .scratch import checkpointed, scratch_path
from .tables import load_table, spread_small_scan
from .tagged import read_tagged_xml, write_tagged_xml

__all__ = [
    "checkpointed",
    "kept",
    "load_table",
    "read_header_csv",
    "read_lines",
    "read_numeric_csv",
    "read_tagged_xml",
    "read_word_list",
    "scratch_path",
    "split_columns",
    "split_first_tab",
    "spread_small_scan",
    "write_lines",
    "write_tagged_xml",
]
