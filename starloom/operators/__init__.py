from starloom.operators.keys import keep_first, dense_key, distinct_rows, keep_existing_keys
from starloom.operators.lookups import (broadcast_bounded, lookup_key, date_key, exact_date_key,
                                        DuplicateLookupKey)
from starloom.operators.setops import stack_columns, missing_keys, anti_rows
from starloom.operators.casts import downcast, downcast_report

__all__ = ["keep_first", "dense_key", "distinct_rows", "keep_existing_keys",
           "broadcast_bounded", "lookup_key", "date_key", "exact_date_key", "DuplicateLookupKey",
           "stack_columns", "missing_keys", "anti_rows", "downcast", "downcast_report"]
