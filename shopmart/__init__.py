"""shopmart — Spark-native order analytics.

Raw wide order lines are cleaned and split into seven core tables, checked
as distributed data-quality jobs, rolled up into a daily store mart and a
daily item mart with popularity ranks, and answered by eight reports.
Everything is DataFrame code; nothing passes whole through the driver.
"""

__version__ = "0.1.0"
