"""feira: marketplace commerce analytics as plain Spark DataFrame jobs.

``feira.sources``    readers and writers (CSV, JSON records, tables, reports)
``feira.operators``  pure ``DataFrame -> DataFrame`` steps
``feira.functions``  column expressions shared by the operators
``feira.plans``      composition, exact rank selection, hot-key handling, shared storage
"""
