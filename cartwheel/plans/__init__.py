"""Named queries over the test tables (``catalog``: batch, ``streamed``:
streaming jobs run to completion) and their SQL statements (``oracle``)."""
