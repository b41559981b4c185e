"""Column -> Column building blocks (scalar functions X1-X19).

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage code generation.
"""

from tramline.functions.dates import (  # noqa: F401
    GERMAN_MONTHS, german_month_name, month_length, parse_dmy, weekday_index,
    weekday_name, dates_from_file_name,
)
from tramline.functions.geo import lv95_to_wgs84  # noqa: F401
from tramline.functions.nulls import (  # noqa: F401
    EMPTY_MARKERS, all_not_null, any_null, is_empty, unify_empty,
)
from tramline.functions.numbers import (  # noqa: F401
    decimal_comma_to_double, ends_with_zero_fraction, range_category,
    round_half_even, row_max, thousands,
)
from tramline.functions.text import (  # noqa: F401
    capitalize, first_token, literal_replace, search_match, split_once,
    strip_grouping_dots, words,
)
