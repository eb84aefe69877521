"""tidemart: e-commerce event and change-log analytics on PySpark.

Every operator is a function from DataFrames to a DataFrame.  Those that need
state across micro-batches also have a Structured Streaming form in
``tidemart.streaming``.
"""
