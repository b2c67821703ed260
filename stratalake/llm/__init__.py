"""Training-data operators. Nothing else in the library imports this subpackage.

Functions of this subpackage that run in executors are sent there by value, so a cluster needs no copy of the
package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
