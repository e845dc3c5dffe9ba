from casework.operators.ranking import (  # noqa: F401
    dense_ids, dense_rank_column, first_per, join_back, join_on, last_per, nth_per,
    scalar_row, sort_like_sql, top_with_ties, with_scalars,
)
from casework.operators.anchor import (  # noqa: F401
    first_after_anchor, first_event_anchor, last_before_anchor, member_flag,
    relative_to_anchor, totals_relative,
)
from casework.operators.rewards import (  # noqa: F401
    pay_per_unit, points, price_by, rule_ladder, within_days_after,
)
from casework.operators.rates import (  # noqa: F401
    cond_counts, correlation_label, correlation_summary, distinct_and_flagged, share_of_total,
    success_rate,
)
from casework.operators.multivalue import explode_bag, tagged_explode_outer  # noqa: F401
from casework.operators.lifecycle import (  # noqa: F401
    first_row_next, milestone_after_anchor, state_at,
)
from casework.operators.ranges import (  # noqa: F401
    counts_over_time, last_anchor, last_known, next_value, previous_value, rank_columns, scan_in_order,
)
from casework.operators.assemble import counted_list, filtered_lists, ordered_list  # noqa: F401
from casework.operators.contract import (  # noqa: F401
    check, contract_summary, not_null, split_valid, tag_violations,
)
from casework.operators.groupstats import with_group_stats  # noqa: F401
from casework.operators.rejects import measure_fault, parse_with_rejects  # noqa: F401
