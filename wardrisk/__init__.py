"""District risk analytics as PySpark DataFrame operators.

Sub-packages: ``functions`` (column expressions), ``operators`` (DataFrame to
DataFrame), ``sources`` (readers and writers), ``streaming`` (Structured
Streaming wiring) and ``plans`` (the bronze/silver/gold jobs and the queries
bound to the TPC-H-like test tables).
"""
