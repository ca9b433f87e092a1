"""feedlens: feed analytics (engagement classification, top tags per category) on Spark.

Layout
------
``schema``     feed / dictionary schemas and the fixed values of the analytics
``functions``  Column expressions (parsing, ratio, classes, tag splitting, rendering)
``operators``  DataFrame -> DataFrame building blocks (union, filters, explode,
               counts, top-k, naming joins, first-per-key, running lists)
``sources``    CSV feeds, JSON-lines dictionary, text lines, driver-table testbed
``sinks``      CSV, managed tables, CTAS, key/value text
``plans``      end-to-end analytics, the SQL twin, the query catalogue and oracle
``streaming``  the top-tags analytic over a stream of feed files
``jobs``       command-line jobs over real files (``python -m feedlens``)
"""

__version__ = "0.1.0"
