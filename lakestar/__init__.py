"""lakestar: medallion and dimensional-modelling operators on PySpark DataFrames."""

__version__ = "0.1.0"
