"""Training-data operators: URL trust, mixing, decontamination, fingerprints, toxicity,
near-duplicates, personal data, secrets, repeated passages and quality.

Nothing else in the library imports this package. Functions that run inside tasks are
shipped with the job by value, so executors need no copy of the package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
