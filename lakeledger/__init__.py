"""Water-reservoir analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame; keys are column names, so one call
serves any number of reservoirs.
"""
