"""Spark toolkit for taking large flat event tables from raw files to model-ready features.

* ``functions``  column expressions (text, casts, calendar, holidays)
* ``sources``    readers and writers
* ``operators``  DataFrame -> DataFrame building blocks
* ``plans``      the end-to-end flows assembled from them
"""
