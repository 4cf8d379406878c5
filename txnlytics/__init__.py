"""PySpark operators and batch jobs for bank-transaction analytics."""

from txnlytics.params import Params

__all__ = ["Params"]
