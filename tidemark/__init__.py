"""Portfolio-snapshot analytics on Spark: every operator is a DataFrame -> DataFrame function."""

from tidemark.params import DEFAULT, Params

__all__ = ["DEFAULT", "Params"]
