from .measure import (
    flag_discrepancy, range_direction, range_flag, standard_unit, standard_value, standardise,
)
from .metrics import (
    ever, hi, lo, median, n, n_distinct, n_distinct_if, n_if, rate, total, variants,
)
from .normalize import (
    as_col, band, blank_to_null, delivery_date, elapsed_days, is_missing, map_flag, map_values,
    normalize_category, normalize_key, normalize_unit, parse_date, stamp, typed,
)
