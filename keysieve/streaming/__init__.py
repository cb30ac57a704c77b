"""Streaming.

The analysed pipeline is batch only: every source is a bounded scan of a word
list, a breach corpus, Parquet or CSV, and there is no watermark, window,
session or state. So no stream operator is built here.

The batch operators are plain ``DataFrame -> DataFrame`` functions without
actions, so they also apply unchanged to a ``spark.readStream`` source
(for example a directory that receives new word lists, joined stream-static
against the breach corpus). Nothing beyond Spark's own file source is needed.
"""
