"""Operators for training-data pipelines (numbered 1 to 13 in the README).

Functions that run inside tasks are pickled by value, so executors need this
package on no path of their own.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
