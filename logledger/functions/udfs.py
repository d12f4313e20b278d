"""User functions callable from SQL text (Arrow-batched pandas UDFs).

No ``from __future__ import annotations`` here: pandas UDF type hints must be
real types for Spark to infer the UDF kind.  The function body is built
inside a factory, so it is shipped to the Python workers by value and they
need not import this package.
"""

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def make_zip_to_int():
    """Zip text -> int; null when not a whole number in int range (as
    ``try_cast(zip AS INT)``, the native form)."""

    def zip_to_int(z: pd.Series) -> pd.Series:
        # an optional sign and digits, as the cast reads them
        digits = z.str.strip().str.extract(r"^([+-]?[0-9]+)$", expand=False)
        n = pd.Series([None if pd.isna(t) else int(t) for t in digits], dtype="object")
        return n.where(n.map(lambda x: x is not None and -2**31 <= x < 2**31), None).astype("Int32")

    return F.pandas_udf(zip_to_int, "int")


zip_to_int = make_zip_to_int()


def register_zip_to_int(spark: SparkSession, name: str = "zip_to_int") -> None:
    spark.udf.register(name, make_zip_to_int())
