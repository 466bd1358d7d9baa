"""Operators for large text corpora; ``queries`` applies each to its whole table.

Executors import this package where it is installed, on PYTHONPATH or in the working folder.
Where it is in none of these, its functions travel to them by value.
"""

import os as _os
import sys as _sys
import sysconfig as _sysconfig

from pyspark import cloudpickle as _cloudpickle

_root = _os.path.dirname(_os.path.dirname(_os.path.dirname(_os.path.abspath(__file__))))
if _root not in {_os.getcwd(), *_os.environ.get("PYTHONPATH", "").split(_os.pathsep), *_sysconfig.get_paths().values()}:
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
