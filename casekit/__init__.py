"""casekit — customer-case and survey analytics as Spark DataFrame operators.

Plain functions ``DataFrame -> DataFrame``; configuration in dataclasses; no
global session, no RDDs and no Python UDFs.  Sub-packages:

* ``functions``  column expressions (casting, time windows, JSON, sentiment)
* ``operators``  DataFrame operators (merge, latest-per-key, enrich, bands, KPIs)
* ``sources``    batch scans and sinks (delimited, JDBC, warehouse tables)
* ``plans``      composite jobs (fact, wide table, KPI report, loads)
* ``streaming``  Structured Streaming jobs (decode, land, live KPIs, joins)
"""

__version__ = "0.1.0"
