"""geotaxa: versioned, geo-temporal observation records on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function built from Spark
SQL expressions, joins, aggregations and windows, so Catalyst can push filters
into the scan, prune columns and pick the join strategy.

Sub-packages:

* ``sources``   -- table loading, the test fixture, incremental (high-water
                   mark) pulls against a sync history.
* ``operators`` -- version selection, deduplication, taxa filters, name
                   normalization, feature enrichment, request building,
                   exact in-group ranking, job counters.
* ``functions`` -- column-level helpers (word test, JSON, grid, joins for
                   skewed keys).
* ``sinks``     -- schema enforcement and file writers.
* ``plans``     -- the three end-to-end jobs and plan checks.
"""

__version__ = "0.1.0"


def _ship_by_value() -> None:
    """Functions of this package that run on executors (``mapInPandas``
    bodies, user fetch helpers defined here) are pickled by value, so the
    workers do not need the package installed."""
    try:
        import sys

        from pyspark import cloudpickle

        cloudpickle.register_pickle_by_value(sys.modules[__name__])
    except Exception:  # pragma: no cover - older cloudpickle
        pass


_ship_by_value()

# Public API: the jobs and the operators a user composes them from.
from geotaxa.operators.dedup import one_request_per_cell, spatial_dedup  # noqa: E402
from geotaxa.operators.features import (FeatureSpec, combine_features, feature_vectors,  # noqa: E402
                                        fetch_missing_features, grouped_occurrences,
                                        join_existing_features, merge_features,
                                        missing_feature_keys)
from geotaxa.operators.names import normalize_names  # noqa: E402
from geotaxa.operators.ranking import ordered_rank  # noqa: E402
from geotaxa.operators.requests import (batched_requests, cell_requests, feature_requests,  # noqa: E402
                                        sample_batches, unwind_cells)
from geotaxa.operators.taxa import name_distribution, taxa_threshold, top_names, valid_names  # noqa: E402
from geotaxa.operators.versions import latest_version  # noqa: E402
from geotaxa.plans.jobs import enrich_features, harvest, read_occurrences  # noqa: E402
from geotaxa.sources.sync import incremental_pull, next_marks  # noqa: E402

__all__ = [
    "FeatureSpec", "batched_requests", "cell_requests", "combine_features", "enrich_features",
    "feature_requests", "feature_vectors", "fetch_missing_features", "grouped_occurrences",
    "harvest", "incremental_pull", "join_existing_features", "latest_version", "merge_features",
    "missing_feature_keys", "name_distribution", "next_marks", "normalize_names",
    "one_request_per_cell", "ordered_rank", "read_occurrences", "sample_batches",
    "spatial_dedup", "taxa_threshold", "top_names", "unwind_cells", "valid_names",
]
