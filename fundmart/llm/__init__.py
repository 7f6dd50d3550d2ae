"""Operators for preparing training data; nothing else in the library imports them.

What runs in tasks is sent to the executors with the plan, so they need no copy of this
package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
