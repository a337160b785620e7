"""Stopline: daily public-transit timetable snapshots, landed and analysed with Spark."""

import sys

from pyspark import cloudpickle

# The package goes along with the tasks that run Python, so that executors need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
