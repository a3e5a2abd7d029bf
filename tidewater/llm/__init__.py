"""Training-data operators: dedup, language, mixing, personal data, quality,
token counts, url rules and sub-word encoding as Spark jobs.

Nothing else in the library imports this subpackage.  Functions that run
inside Python tasks are pickled by value, so executors need no installed copy
of the library.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
