"""Find rows of a table of short texts that mean the same, on Spark.

Every step is a function from DataFrame to DataFrame; see ``plans.dedup`` for the
whole run and the README for the map of modules.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code along, so the package need not be
# installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from samesense.plans.dedup import (  # noqa: E402
    deduplicate,
    deduplicate_incremental,
    detect_duplicates,
    prepare_previous,
)

__all__ = [
    "deduplicate",
    "deduplicate_incremental",
    "detect_duplicates",
    "prepare_previous",
]
