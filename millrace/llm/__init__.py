"""Operators of a training-data pipeline, each with its registered query.

Nothing else in the library imports this folder.
"""

import sys

from pyspark import cloudpickle

from millrace.llm.common import ORACLES, QUERIES

from millrace.llm import (  # noqa: E402,F401  each module registers its query
    mixing, toxicity, exact_dedup, warc, language, jaccard_join, neighbours, quality, sharding, pieces,
    merkle, byte_pairs, fill_middle,
)

# Executors need no copy of this folder: what tasks run is sent along with them.
for _name in [name for name in sys.modules if name.startswith("millrace.llm.")]:
    cloudpickle.register_pickle_by_value(sys.modules[_name])

__all__ = ["ORACLES", "QUERIES"]
