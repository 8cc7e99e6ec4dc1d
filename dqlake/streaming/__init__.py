from .jobs import (
    apply_changes, read_history, read_quarantine, read_reissued, read_valid, release, route_feed, run_once,
)
