"""Training-data operators: one module per operator, plus small helpers.

Nothing outside this subpackage imports it. Registered queries live in
``queries.py`` and their DuckDB SQL in ``sql.py``.
"""

import sys

from pyspark import cloudpickle

# Task functions travel to the executors with their code, so a job does not
# depend on the package being installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
