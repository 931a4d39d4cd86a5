"""DataFrame -> DataFrame operators."""

from geotaxa.operators import (dedup, features, metrics, names, ranking, requests,
                               taxa, versions)

__all__ = ["dedup", "features", "metrics", "names", "ranking", "requests", "taxa", "versions"]
