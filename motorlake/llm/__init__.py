"""Training-data operators; nothing outside this folder imports them.

Worker code travels inside the plans: executors need no copy of the package.
"""

from pyspark import cloudpickle

import motorlake

cloudpickle.register_pickle_by_value(motorlake)
