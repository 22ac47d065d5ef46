"""Operators for preparing training text, one module each; nothing else in the library imports them.

Code that runs inside tasks is sent along with them, so executors need no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
