"""ballotlake: election-data analytics as PySpark DataFrame transformations.

Every public operator is a function ``DataFrame -> DataFrame`` (or a small
dict of them) built from Spark's own expressions, so Catalyst plans, prunes
and pushes down the whole job. Column names are parameters: the same
operator runs on ballot files and on any stand-in table.
"""

__version__ = "0.1.0"
