"""pitwise: point-in-time credit-risk features as Spark DataFrame jobs.

Every feature is a pure function from DataFrames to a DataFrame built from
built-in Spark expressions, so Catalyst plans, prunes and pushes down the
whole job. See README.md for the operator list.
"""

__version__ = "0.1.0"
