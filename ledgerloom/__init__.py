"""Daily retail sales and inventory analytics, written as Spark DataFrame plans.

Layout: ``sources`` read and check input, ``operators`` are reusable DataFrame transforms,
``plans`` are the models built from them, ``sinks`` write, ``streaming`` runs the same plans
on an unbounded feed, and ``catalog`` registers every query together with its check SQL.
"""

from ledgerloom.params import Params

__all__ = ["Params"]
