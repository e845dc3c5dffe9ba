from casework.functions.clean import (  # noqa: F401
    MISSING_TOKENS, MISSING_TOKENS_WITH_NAN, digits_as_number, null_tokens, parse_measure, unreadable_measure,
)
from casework.functions.arrays import bag_edit, empty_if_null, tokens  # noqa: F401
from casework.functions.text import (  # noqa: F401
    concat_skip_nulls, exact_ratio, optional_fragment, percent_text,
)
from casework.functions.timeparts import (  # noqa: F401
    date_after, date_at_most, day_bucket_label, days_between, elapsed_micros,
    elapsed_minutes, hour_of_day, in_year, minute_field, month_start, week_from_jan1,
    weekday_name,
)
from casework.functions.aggregates import distinct_count, quotient  # noqa: F401
