"""Product-analytics jobs for a news feed and a messenger, as Spark DataFrame plans."""

import sys

from pyspark import cloudpickle

# The few Python kernels travel inside the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
