"""leadscope: search-activity and lead-report jobs expressed as Spark DataFrame plans.

Every job is a function from DataFrames to a DataFrame; Catalyst plans each one from
scan to write.  Sub-packages:

* ``functions`` – column expressions (text cleaning, name match, tolerant numbers, dates)
* ``sources``   – scans of raw text exports, JDBC tables, the partitioned activity dataset, sinks
* ``operators`` – the jobs (profiles, totals, share, leads reconciliation, audits)
* ``plans``     – fixture views over the driver tables, the job catalogue and oracle SQL
* ``streaming`` – incremental (file-stream) form of the activity ingest
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
