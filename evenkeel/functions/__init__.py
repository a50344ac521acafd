"""Column functions and small name helpers."""

from evenkeel.functions.names import column, parse_list, sheet_name
from evenkeel.functions.text import canonical_text

__all__ = ["canonical_text", "column", "parse_list", "sheet_name"]
