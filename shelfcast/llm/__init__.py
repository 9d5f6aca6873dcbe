"""Operators for training-data pipelines over documents, labels and conversations."""

from pyspark import cloudpickle

import shelfcast

# Functions that tasks run travel with the task, so workers need no installed package.
cloudpickle.register_pickle_by_value(shelfcast)
