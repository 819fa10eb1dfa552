"""Keyed state machines for what streams cannot express with built-in operators.

Their functions are sent to the executors by value, so the executors need no copy of this
package.
"""

import sys

from pyspark import cloudpickle

import roadstream.functions
import roadstream.operators

for _module in (sys.modules[__name__], roadstream.functions, roadstream.operators):
    cloudpickle.register_pickle_by_value(_module)
