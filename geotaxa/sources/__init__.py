"""Sources: table loading, the fixture views and sync-driven pulls."""

from geotaxa.sources.tables import load_table
from geotaxa.sources.files import read_json_records
from geotaxa.sources import fixture, sync

__all__ = ["load_table", "read_json_records", "fixture", "sync"]
