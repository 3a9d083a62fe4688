"""ledgerlens: filing-table extraction and column/cell embedding as Spark jobs.

Everything is DataFrame -> DataFrame (or Column -> Column); see the
sub-packages:

* ``functions``  - column expressions (text rules, numbers, vectors, hashing)
* ``sources``    - readers / writers (filing folders, CSV, derived test tables)
* ``operators``  - whole-table operators (filings, tables, columns, vectors,
                   retrieval, cells, training-data preparation)
* ``plans``      - end-to-end plans and the query / oracle registry
* ``streaming``  - incremental filing scan (Structured Streaming)
"""

from ledgerlens.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
