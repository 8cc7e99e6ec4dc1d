from .delimited import RESCUED, bind, bindings, header_drift, header_lines, read_lines
from .ingest import (
    feed_inventory, ingest_feed, ingest_snapshot, known_types, landing_inventory, read_feed,
    read_snapshot, rescue, rescued_values, text_schema, typed_feed, with_lineage,
)
from .types import merged_types, observe_types, type_drift
from .workspace import new_folder, work_root
