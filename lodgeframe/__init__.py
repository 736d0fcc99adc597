"""lodgeframe: Spark-native analytics for short-term-rental data.

Neighbourhood summaries, point-in-time feature sets, model evaluation,
batch scoring under an input contract, text embedding and filtered
top-k vector search, all expressed as DataFrame / Spark SQL jobs.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code with them, so the workers need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
