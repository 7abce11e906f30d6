"""Operators of a training-data pipeline over the text tables.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.  One module
per operator, ``queries.py`` registers them.  Functions that run in Python
workers are shipped by value, so executors need no installed copy.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
