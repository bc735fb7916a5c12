"""twinledger: reconcile the same records held in two systems and plan the load between them.

Everything is a function from DataFrames to DataFrames.  Sub-packages:

* ``functions``  column expressions (text, typed values, payload maps, error texts)
* ``sources``    scope and rule readers, wide-to-long extraction, partitioned stores
* ``operators``  joins, aggregates, ranking, graph walks
* ``plans``      multi-step jobs: prepare work, plan operations, apply them, one-table moves
* ``streaming``  Structured Streaming forms of extraction and result tracking
"""
