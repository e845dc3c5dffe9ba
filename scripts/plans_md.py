"""Regenerate PLANS.md: annotated plan trees of representative jobs and the
skew-probe table.

usage: python scripts/plans_md.py [sf_dir] [probe_json]
(probe_json is the output of scripts/skew_probe.py; without it the probe
section of the current PLANS.md is kept)
"""

import json
import os
import subprocess
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(HERE)

notes = {
"spend_per_customer": "Two-column scans (`ReadSchema`). Lines are priced by joining `part` and summed per order "
    "*before* meeting `orders` (partial + final `HashAggregate`), so the second join sees one row per order. "
    "Both joins carry no hint: the static plan broadcasts the dimensions because they are small here; on a "
    "cluster AQE keeps a sort-merge join when `part`/`orders` exceed the broadcast threshold, and its skew-join "
    "rule splits a hot part key.",
"upgrades_in_year": "`date_part('year', d) = 1997` is rewritten to a half-open range, so both bounds and the "
    "status equality reach the Parquet reader (`PushedFilters`) for row-group skipping. `count(distinct)` "
    "runs as two aggregation levels (by (customer) then global) without `Expand`.",
"events_after": "Date bound pushed as `GreaterThanOrEqual(ts, ...)`; grouped count then the reference's "
    "`ORDER BY n DESC` as a range-partitioned sort.",
"bag_edit_counts": "Delivered lines are counted per part first (filter `l_returnflag <> 'R'` pushed into the "
    "scan), the bag edit (`array_except` + `concat`) runs once per part inside a `Generate`, and each "
    "ingredient is weighted by its part's line count: the explode never sees line-level rows.",
"optional_label": "Lines are counted per (order, part key) on numeric keys (both filtered counts in one "
    "aggregate) and only then joined to `part` for the names; the second level collects one struct per "
    "part per order (bounded by the item domain, not the line count), sorted by name, and expands the counts. "
    "`FILTER (WHERE ...)` becomes `count_if`, `coalesce(' - x ' || list, '')` a plain projection.",
"line_id": "`row_number()` over a global order without a single-partition window: a one-row "
    "min/max/count aggregate (a scalar subquery, run once) sizes value ranges of the leading key; "
    "a per-range table (one row per range, broadcast) marks ranges holding a hot leading value, which are "
    "split by ranges of the second order column; counts and running offsets are computed on one row per "
    "piece, and each piece is numbered by its own task. The join on the piece keys keeps the hash "
    "partitioning the numbering window needs, so `lineitem` is shuffled once. The extra scans read only "
    "the two leading columns.",
"member_rank": "`CASE WHEN member = 'Y' THEN dense_rank() ... END`: the window runs over distinct "
    "(user, date) pairs of member rows only, then the rank is joined back (left outer). A user with a third "
    "of all events contributes at most one row per day to the window.",
"state_at_date": "State at a date = last row per user with `ts` under the bound: a `max_by` aggregate "
    "(partial per map task; sort-based because the ordering key is a struct) instead of `lead` + "
    "`IS NULL`. The share of total is a window over the few group rows.",
"next_plan_lead": "`lead(event_type)` at each user's first row needs that user's first two rows: `row_number <= 2` "
    "with a partial group limit before the shuffle, one aggregate per user in the same partitioning, and a "
    "window over the few group rows for the share.",
}

PROBE_PAIRS = [
    ("first day per user (dense_rank = 1)", "first day per user: window dense_rank = 1",
     "first day per user: top_with_ties",
     "`first_per` / `top_with_ties`: the window + rank filter itself, so Catalyst adds a partial group limit before the shuffle"),
    ("second day per user (dense_rank = 2)", "second day per user: window dense_rank = 2",
     "second day per user: nth_per", "`nth_per`: same, limit 2"),
    ("dense rank of day as a column", "dense rank of day: window",
     "dense rank of day: dense_rank_column (distinct pairs)",
     "`dense_rank_column`: window over distinct (user, day) pairs, joined back"),
    ("next event type (lead)", "next event type: window lead",
     "next event type: next_value (user, hour buckets)",
     "`next_value`: window per (user, hour), bucket heads linked by a small window"),
    ("next event type, hot user's third of the log in one hour", "next event type, hot user in one hour: window lead",
     "next event type, hot user in one hour: next_value, second buckets",
     "`next_value` with a bucket of a second; with hour buckets "
     "it would read {next event type, hot user in one hour: next_value, hour buckets} rows"),
    ("state at a date", "state at date: window lead + IS NULL",
     "state at date: state_at (max_by aggregate)", "`state_at`: `max_by` aggregate, combined map-side"),
    ("average per user on every row", "average per user on every row: window avg",
     "average per user on every row: with_group_stats",
     "`with_group_stats`: partial aggregate joined back; AQE splits the hot key's join partition"),
    ("global row number by event id", "global row number: window row_number", "global row number: dense_ids",
     "`dense_ids`: equal-depth ranges of the order, running offsets over one row per range"),
    ("global row number by (user, event), hot leading user", "row number by (user, event): window row_number",
     "row number by (user, event): dense_ids (hot user split)",
     "`dense_ids`: ranges of all order columns, so a hot user spans several"),
]


def probe_section(d):
    m = d["max_shuffle_rows_read_by_one_task"]
    lines = ["## Skew probe", "",
             f"`scripts/skew_probe.py` relabels every third row of `events` (sf 0.1, {d['rows']:,} rows) to one user, so that",
             f"user holds {d['hot_user_rows']:,} rows, writes it as 32 files (many map tasks, as on a cluster) and runs each",
             "operator next to the plain window it replaces: 32 shuffle partitions, broadcast joins disabled to force the",
             "shuffle path, AQE skew-join split forced and its thresholds scaled down with the data (256 KB instead of",
             "256 MB). The largest number of shuffle rows read by a single task, from Spark's event log:", "",
             "| question | plain window | casework operator | how |", "| --- | ---: | ---: | --- |"]
    for q, a, b, how in PROBE_PAIRS:
        for k, v in m.items():  # "{variant}" in the text is that variant's count
            how = how.replace("{" + k + "}", f"{v:,}")
        lines.append(f"| {q} | {m[a]:,} | {m[b]:,} | {how} |")
    lines += ["",
              "A first version of `first_per` / `nth_per` used an aggregate plus a join back; the probe showed that form",
              "shuffling far more rows of the hot user into one task than the window, whose partial group limit runs before",
              "the shuffle, so they now use the window form. What remains for `dense_rank_column` and `next_value` is",
              "several pieces hashed to the same one of 32 partitions.", ""]
    return "\n".join(lines)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    order = list(notes)
    out = subprocess.run([sys.executable, os.path.join(HERE, "plans_report.py"), sf_dir, *order],
                         capture_output=True, text=True, check=True).stdout
    body = {s.split("`")[1]: "### " + s for s in out.split("### ")[1:]}
    path = os.path.join(ROOT, "PLANS.md")
    old = open(path).read() if os.path.exists(path) else ""
    if len(sys.argv) > 2:
        probe = probe_section(json.load(open(sys.argv[2])))
    else:
        probe = old[old.index("## Skew probe"):] if "## Skew probe" in old else ""
    census = subprocess.run([sys.executable, os.path.join(HERE, "plan_census.py"), sf_dir],
                            capture_output=True, text=True, check=True).stdout
    with open(path, "w") as f:
        f.write("# Physical plans\n\n"
                "Formatted physical plans of representative jobs at sf 0.1 (Spark 4.1.2, `local[*]`, 16 shuffle\n"
                "partitions, AQE on), generated with `scripts/plans_md.py`. They are the plans *before*\n"
                "execution: at run time AQE turns a sort-merge join into a broadcast only when the measured side\n"
                "is under `spark.sql.autoBroadcastJoinThreshold`, coalesces small shuffle partitions and splits\n"
                "skewed ones. `Project`/`Filter` nodes are kept as printed.\n\n")
        for n in order:
            head, rest = body[n].split("\n", 1)
            f.write(head + "\n\n" + notes[n] + "\n" + rest + "\n")
        f.write("## Every registered job: operator census\n\n"
                "Counted by `scripts/plan_census.py` from each job's *final* adaptive plan after one run at\n"
                "the same scale (main query and scalar subqueries; `reused` = exchanges AQE reused instead of\n"
                "shuffling again). `hash`/`range`/`single` are shuffles by partitioning; `partial limit` is the\n"
                "map-side `WindowGroupLimit` of rank filters; `sort agg` comes from `min`/`max_by` over struct\n"
                "orderings (still partial per map task). Broadcasts here are AQE's or static choices under\n"
                "the size threshold; no join carries a hint.\n\n"
                + census + "\n")
        f.write(probe)


if __name__ == "__main__":
    main()
