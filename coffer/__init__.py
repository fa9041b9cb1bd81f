"""Household-ledger analytics as Spark jobs.

Sheets land as text, are staged and cleaned, loaded once into a star schema, and
summarised by views, marts and reports.  Every step is a DataFrame in, DataFrame
out function, so Catalyst sees the whole plan.
"""

import sys

from pyspark import cloudpickle

from coffer.schema import Ledger

# Functions of this package that run in Python workers travel with their code, so the
# workers need no copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Ledger"]
