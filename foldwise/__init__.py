"""foldwise: leak-free tabular profiling, preparation and modelling on Spark DataFrames."""

__version__ = "0.1.0"
