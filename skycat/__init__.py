"""skycat: Spark operators for time-domain sky-survey catalogues.

Every operator takes and returns DataFrames (or Columns), so a plan stays one
Catalyst plan from the scan to the sink.  Sub-packages:

functions   Column expressions: geometry, pixel indexes, photometry, times, names
sources     schemas, readers and writers
operators   DataFrame operators
streaming   Structured Streaming twins
plans       the catalogue build and the query registry used by the driver
"""
