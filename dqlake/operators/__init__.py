from .checks import (
    LINEAGE, Layers, Relation, assert_domain, conservation, conversion_coverage, crosstab, domain, dq_breakdown,
    dq_combinations, dq_impact, duplicate_groups, gate, key_completeness, key_history,
    key_history_summary, layer_changes, lineage_completeness, mapping_coverage, missing_patterns, missing_values,
    order_profile, orphan_counts, parse_coverage, profile, quarantine_check, reconcile,
    reference_conflicts, relation_profile, row_counts, sequence_duplicates, sum_constraint, trace,
)
from .resolve import (
    combine_rollups, dedupe_latest, first_by, inherit, key_set, lookup, lookup_fallback, orphans,
    profile_top, rank_within, reference, reissued_keys,
)
from .rollup import calendar, having, rollup, running_sum, stack, top, zero_fill
from .rules import (
    FAILURES, VALID, Routed, Rule, failures, quarantine, requarantine, route, valid_rows, validate,
    warn,
)
from .scd import (
    END, LAST, START, current, hot_keys, late_keys, late_stretches, scd1, scd2, scd2_check, scd2_from_snapshots,
    scd2_refresh, scd2_splice, snapshot_step, touched_versions, with_last, without,
)
from .waiting import ROW_ID, arrived, retest, waiting_index, with_row_id
