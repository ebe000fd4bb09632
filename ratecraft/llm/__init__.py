"""Training-data operators: archive, filters, formatting, tokenisation, de-duplication.

Nothing outside this subpackage imports it; ``queries.QUERIES`` and ``queries.SQL`` are what
the entry module registers.
"""

import sys

from pyspark import cloudpickle

# functions of this subpackage travel to executors by value: they need not have it installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])
