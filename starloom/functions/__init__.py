from starloom.functions.text import (  # noqa: F401
    blank_to_null, concat_nulls_as_empty, keyword_flags, norm_lower, norm_upper,
)
from starloom.functions.hashing import row_hash  # noqa: F401
from starloom.functions.dates import date_key, date_from_key, month_start  # noqa: F401
