"""Cutting lineage with tables in the folder that all executors share."""

from quern.functions.storage import delete_at_end, discard, materialize, reclaim, shared_dir

__all__ = ["delete_at_end", "discard", "materialize", "reclaim", "shared_dir"]
