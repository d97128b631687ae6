"""Operators for preparing large text corpora, and the pipeline's queries.

Nothing outside this subpackage imports it; ``feria.llm.queries`` registers
one query per operator. What its functions need travels to the executors by
value, so they need not have this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
