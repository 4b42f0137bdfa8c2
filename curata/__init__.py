"""curata: news-feed curation as Spark DataFrame operators.

Layout:
    functions/  Column -> Column helpers (URL keys, text clean-up, durations, HTML text)
    sources/    readers and writers (OPML, feed list, ledger CSV, promotions CSV, tables)
    operators/  DataFrame -> DataFrame operators (folders, dedup, generation, publish,
                reconcile, repeat suppression)
    streaming/  Structured Streaming forms (repeat suppression, incremental publishing)
    plans/      stand-in inputs built from the driver tables and the registered queries
"""

__version__ = "0.1.0"
