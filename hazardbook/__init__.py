"""Security-advisory analytics expressed as Spark DataFrame jobs.

``functions``  Column -> Column building blocks
``operators``  generic relational operators, parameterised by column names
``sources``    landed feed files -> typed DataFrames
``sinks``      sorted Parquet batches, the batch manifest, ingest jobs
``plans``      views and published query patterns built from the operators
``streaming``  file-arrival ingest on Structured Streaming
"""
