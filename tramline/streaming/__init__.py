"""Incremental runs over arriving files (Structured Streaming).

The source data arrive as weekly files; ``incremental.clean_new_files``
processes only the files that are new since the last run, with the same
stateless cleaning expressions as the batch operators. There are no
watermarks or stateful operators because no check in the library needs state
across files: the cross-file checks (duplicates, foreign keys, snapshots) run
as batch plans over the cleaned table.
"""
