"""Operators of a training-data pipeline over ``documents``, ``pages``, ``benchmark`` and ``labels``.

One module per operator; ``queries`` registers them. Nothing outside this
subpackage imports it. Functions that run inside tasks are pickled by value,
so executors need the third-party packages but no copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
