"""Operators: every one is ``fn(DataFrame..., params) -> DataFrame`` (the mining ones may
also return a fitted ``pyspark.ml`` model)."""
