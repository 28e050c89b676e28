"""Support-message analytics as Spark jobs.

``functions``  column expressions (clean, label, route, draft, score)
``operators``  DataFrame -> DataFrame (threads, samples, metrics, retrieval, models)
``sources``    readers, writers, stage tables
``plans``      the composed jobs (data sets, prediction, evaluation, whole run)
``streaming``  the rule-based routing on a stream
"""
