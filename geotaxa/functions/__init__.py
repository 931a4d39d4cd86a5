"""Column-level helpers: all built from ``pyspark.sql.functions`` so they stay
inside whole-stage codegen."""

from geotaxa.functions.words import WORD_SEPARATORS, is_multiword, word_count
from geotaxa.functions.json import from_json_record, reject_non_finite, strict_json, to_json_record
from geotaxa.functions.geo import buffered_uncertainty, covering_box, grid_floor, timestamp_literal
from geotaxa.functions.joins import null_safe_condition, own_shuffle

__all__ = [
    "WORD_SEPARATORS", "is_multiword", "word_count",
    "from_json_record", "reject_non_finite", "strict_json", "to_json_record",
    "buffered_uncertainty", "covering_box", "grid_floor", "timestamp_literal",
    "null_safe_condition", "own_shuffle",
]
