"""Training-data operators: fingerprints, mixing, sharding, deduplication,
licence scans, exact search, language identification, extraction, packing.

Nothing else in the library imports this subpackage. Functions that run inside
tasks are pickled by value, so executors need only the third-party wheels.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle


def ships_by_value(module_name: str) -> None:
    """Let tasks receive this module's functions without importing the package."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
