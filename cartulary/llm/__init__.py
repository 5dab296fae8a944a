"""Training-data operators on Spark DataFrames.

Nothing outside this subpackage imports it.  Each module holds one operator;
``queries`` registers the contract queries and ``pipeline_queries`` the
end-to-end corpus pipeline.
"""
