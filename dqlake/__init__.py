"""Data-quality lakehouse operators for PySpark.

``functions``   column expressions: normalising, typing, measures, metrics
``operators``   DataFrame operators: reference resolution, rules, history, checks
``sources``     file ingest with lineage, rescued values, landing inventory
``streaming``   the same work as Structured Streaming jobs
``plans``       the clinical configuration: schemas, silver, gold, full run
``queries``     registered queries over the shared test tables and their SQL twins
"""
