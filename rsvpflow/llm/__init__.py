"""Training-data operators: language, extraction, toxicity, personal data, decontamination, dedup, packing, quality, chat.

Nothing outside this folder, ``corpus_pipeline.py`` and the guarded block of ``__spark_entry__.py`` imports it.
Row-wise work runs in Arrow batches (``batches.py``), everything between rows in DataFrame joins and aggregates.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job: executors need pyspark, numpy and pyarrow, but not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
