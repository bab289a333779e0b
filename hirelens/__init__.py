"""Job-market analytics on Spark.

Entry points:

* ``hirelens.plans.reports``            q01-q14 and v1-v4 over a ``Star``
* ``hirelens.operators.warehouse``      set-based warehouse load (``load_warehouse``)
* ``hirelens.operators.cleaning``       the cleaning chain (``process``)
* ``hirelens.sources.html_cards``       job cards and page triage from saved pages
* ``hirelens.operators.dedupe``         url dedupe across scrape batches
* ``hirelens.operators.quality``        statistics, gate, report, profiles, outliers
* ``hirelens.streaming.incremental``    AvailableNow ingest of landed raw files
* ``hirelens.plans.daily_run``          the daily run in stage order
"""
