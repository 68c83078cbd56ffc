from regmine.functions.text import normalize_text, not_equal_null_safe, is_value  # noqa: F401
from regmine.functions.dates import (  # noqa: F401
    safe_timestamp, safe_timestamp_any, floor_days_between, bounded)
from regmine.functions.bands import age_band_expr, term_band_expr, month_item_expr, year_item_expr  # noqa: F401
from regmine.functions.numeric import r6, safe_long, try_ratio  # noqa: F401
