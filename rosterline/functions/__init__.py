"""Column expressions (all built-in Spark SQL functions; nothing here runs Python per row)."""

from rosterline.functions.text import (  # noqa: F401
    blank_to_default,
    clean_cell,
    is_missing,
    name_key,
    normalize_gender,
    strip_ws,
    token_count,
)
from rosterline.functions.ids import uuid_from_text, row_suffix  # noqa: F401
from rosterline.functions.dates import parse_date, to_number, year_start  # noqa: F401
