"""vectable: labelled binary / vector datasets and classifier evaluation on Spark.

Modules:

* ``vectable.sources``   - parquet tables, labelled file trees (``binaryFile`` /
  ``image``), CSV and Parquet sinks;
* ``vectable.functions`` - column expressions: path labels, display text, data
  URIs, array scaling / standardisation / argmax / softmax;
* ``vectable.operators`` - ``DataFrame -> DataFrame`` operators: labels,
  vectors, images, quality, metrics, batching, reports, model;
* ``vectable.streaming`` - file streams with ``availableNow`` runs;
* ``vectable.plans``     - the registered queries over the driver tables and
  their DuckDB oracle SQL;
* ``vectable.job``       - the end-to-end training / evaluation job (CLI).

Functions that run in tasks are pickled by value: executors need this package
on no path of their own.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
