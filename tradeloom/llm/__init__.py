"""Operators for preparing training data from large document collections.

Functions that run inside Spark tasks are shipped with the job, so executors need not have this
package installed. Nothing outside this subpackage imports it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
