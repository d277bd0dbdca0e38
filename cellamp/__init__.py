"""Single-cell amplicon genotyping on Spark."""

import sys

from pyspark import cloudpickle

from cellamp.config import Params, Region, RegionConfig

# The functions that run in Python workers travel with their definition, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Params", "Region", "RegionConfig"]
