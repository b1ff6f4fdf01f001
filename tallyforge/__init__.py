"""tallyforge: parameterised analytics operators and ready-made analyses on Spark DataFrames."""

__version__ = "0.1.0"
