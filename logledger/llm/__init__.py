"""Operators for preparing language-model training data, each a Spark job.

Nothing else in the library imports this subpackage.  Executors import it, so
submit jobs with the package on their path (``--py-files``).
"""
