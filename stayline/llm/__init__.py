"""Operators for large-scale training-data pipelines.

Self-contained: nothing outside this folder imports it. Helper functions that
run inside tasks are shipped by value, so executors need no copy of the
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
