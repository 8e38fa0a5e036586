"""Cutting lineage with tables in the folder that the cluster shares."""

from tonehive.tables import delete_at_end, scratch, shared_dir
from tonehive.tables import written as cut

__all__ = ["cut", "delete_at_end", "scratch", "shared_dir"]
