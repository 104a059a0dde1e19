"""Operators for preparing training data. Nothing outside this folder imports it.

Executors need not have this package installed: functions of it travel with the task.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
