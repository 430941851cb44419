"""Operators of a training-data pipeline. Nothing else in the library imports this package.

Its functions travel to the executors with the tasks, and what they use of the library with them, so that nothing of it
need be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules["panelkit"])
