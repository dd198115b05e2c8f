"""Column-level helpers: all built-in Spark expressions, no Python UDFs."""

from lodestar.functions.text import (strip, title_case, title_strip, text_cast,
                                     value_map, not_blank)
from lodestar.functions.numbers import lenient_number, percentage
from lodestar.functions.dates import (lenient_timestamp, date_key, key_month,
                                      key_to_date, month_of, month_key, month_text,
                                      as_of_literal)
from lodestar.functions.changes import (differs_3valued, differs_null_safe,
                                        change_text, join_changes)

__all__ = [
    "strip", "title_case", "title_strip", "text_cast", "value_map", "not_blank",
    "lenient_number", "percentage", "lenient_timestamp", "date_key",
    "key_month", "key_to_date", "month_of", "month_key", "month_text", "as_of_literal",
    "differs_3valued", "differs_null_safe", "change_text", "join_changes",
]
