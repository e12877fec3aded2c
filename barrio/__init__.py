"""barrio — area x year analytics on Spark.

Turns periodic open-data drops (nested JSON price histories, yearly CSV
incident files with shifting headers, point-of-interest snapshots) into one
clean table per area and year, then labels, tunes and ranks classifiers on
it.  Every stage is a DataFrame -> DataFrame function so Catalyst sees one
plan; the only driver-side values are schema metadata, file listings, two
quantile cut points and model metrics.

Sub-packages and modules
    functions  column expressions (keys, casts, dates, hash noise)
    sources    scans, sinks, the processed-file ledger and keyed upserts
    operators  flattening, header mapping, dedupe, aggregates, joins,
               labels, projections, model search and the leaderboard
    streaming  batch and Structured Streaming incremental loads
    zones      stage functions: landing -> formatted -> exploitation
               (also ``python -m barrio <stage>``)
    session    local defaults, cluster defaults, the shared scratch folder
    plans      the query catalog over the driver's test tables
"""

__version__ = "0.1.0"
