"""Training-data pipeline operators over document tables.

Nothing else in the library imports this package; ``queries.py`` names the
registered queries and ``__spark_entry__.py`` adds them when the package is
present.
"""
