"""listingflow: a property-listing lakehouse written as plain PySpark DataFrame jobs.

Layers: ``sources`` (tables, fixtures, calendar), ``functions`` (column expressions),
``operators`` (``DataFrame -> DataFrame`` steps), ``plans`` (silver, gold, star queries and the
batch runner) and ``streaming`` (bounded file ingest).
"""

__version__ = "0.1.0"
