"""Sources and sinks: landing files, raw tables, seeds, views, tables."""

from reelmart.sources.costored import CoStored
from reelmart.sources.landing import (SEED_SCHEMA, append_raw, append_snapshot_days, as_table,
                                      as_view, land_payloads, load_checked, load_new, load_raw, loaded_files, merge_fact,
                                      raw, read_seed, snapshot_table, write_seed)
from reelmart.sources.tables import Versioned, write_once

__all__ = ["CoStored", "SEED_SCHEMA", "Versioned", "append_raw", "append_snapshot_days", "as_table", "as_view",
           "land_payloads", "load_checked", "load_new", "load_raw", "loaded_files", "merge_fact", "raw", "read_seed",
           "snapshot_table", "write_once", "write_seed"]
