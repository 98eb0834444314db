"""Training-data operators and their registered queries.

Nothing else in the library imports this subpackage. Each module holds one
operator with a general interface; :mod:`fraudlake.llm.queries` derives the
registered ``opN_*`` results from them.
"""

import sys

from pyspark import cloudpickle

# Functions go to the executors by value: those need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
