"""tallyline: two-sided contest analytics (games, quoted lines, grading,
features and win-rate statistics) expressed as Spark DataFrame plans.

Sub-packages
------------
sources    readers for game records, nested quote documents, CSV, pages,
           fixture views over the driver's test tables
functions  Column-level helpers (dates, time zones, regex/HTML, JSON,
           arrays, logit, Beta distribution pandas UDFs)
operators  DataFrame -> DataFrame building blocks (long form, windows,
           joins, aggregates, de-duplication, table mutation, grading,
           name matching, consensus, data-quality checks)
plans      composite queries users run (feature table, odds pipeline,
           NFL sync chain, reports, posterior statistics)
streaming  Structured Streaming forms of the upsert / dedup / late-data /
           per-window line jobs
"""

__version__ = "0.1.0"
