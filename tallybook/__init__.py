"""Transaction-ledger analytics as plain Spark DataFrame jobs.

Layers, from the outside in:

* ``sources``    - statement inbox, rule files, profiles, lake tables
* ``functions``  - column expressions (dates, money, keys, labels)
* ``operators``  - DataFrame to DataFrame steps (canonicalize, standardize, rules, roll-ups)
* ``sinks``      - lake tables and per-profile CSV exports
* ``streaming``  - the incremental inbox job
* ``plans``      - whole jobs and reports made from the steps above
"""
