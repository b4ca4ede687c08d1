"""Operators that prepare training data for language models; nothing else imports this package."""

import sys

from pyspark import cloudpickle

# tasks get the functions of this package by value: workers need no copy of it on their path
cloudpickle.register_pickle_by_value(sys.modules[__name__])
