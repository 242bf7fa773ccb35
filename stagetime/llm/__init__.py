"""Training-data operators: packing, scoring, deduplication, search and export of text corpora.

Nothing outside this folder imports it.  Every operator takes and returns DataFrames; text work
runs in Arrow batches inside Spark tasks, and Spark does all partitioning, joining and grouping.
"""
