"""Sinks: schema enforcement and writers."""

from geotaxa.sinks.writers import (append_occurrences, append_table, enforce_schema,
                                   occurrence_rows, write_json_lines)

__all__ = ["append_occurrences", "append_table", "enforce_schema", "occurrence_rows",
           "write_json_lines"]
