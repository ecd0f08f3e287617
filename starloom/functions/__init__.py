from starloom.functions.text import title_case, upper_case, null_tokens
from starloom.functions.dates import (date_id, month_name, weekday_iso, weekday_name,
                                      is_weekend, floor_days, calendar_columns)

__all__ = ["title_case", "upper_case", "null_tokens", "date_id", "month_name",
           "weekday_iso", "weekday_name", "is_weekend", "floor_days", "calendar_columns"]
