"""Training-data operators.

Every operator lives in a module of its own and works on any DataFrame; ``queries`` applies them to the tables.
Functions that run on executors travel by value, so workers need the third-party libraries only, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
