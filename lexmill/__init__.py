"""lexmill: lexicon building, segmentation and n-gram statistics on Spark."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Workers of an interactive or notebook session need not have this package on
# their path: what a task needs of it travels with the task.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
