from lakestrata.functions.calendar import add_calendar
from lakestrata.functions.columns import cast_columns, lowercase_columns, lowercase_schema
from lakestrata.functions.rows import literal_rows, to_rows

__all__ = ["add_calendar", "cast_columns", "literal_rows", "lowercase_columns", "lowercase_schema", "to_rows"]
