"""Operators for large training-data pipelines: mixing, quality rules, toxicity, secrets, WARC,
near-duplicates, a quality classifier, chat formatting, sharding, benchmark decontamination, hard negatives,
packing and embedding whitening.

Nothing else in the library imports this subpackage. Functions that run inside tasks are pickled by
value, so executors need no copy of the library on their path.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
