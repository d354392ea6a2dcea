"""Equity-market reference data as Spark DataFrames.

``functions``  column expressions
``sources``    scans: listing pages, CSV, JSON reports, catalogs, archives, tables
``operators``  keys, order, snapshots, rejects, table writes, exports
``plans``      the user-level jobs, composed from the above
``streaming``  the archive intake as a bounded stream
"""
