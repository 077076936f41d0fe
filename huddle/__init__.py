"""huddle: matchup analytics on Spark.

Lazy DataFrame operators for two-sided, season/week-sequenced event data:
per-side weekly aggregates, leakage-free history features, matchup rows,
line evaluation, closed-form and tree regressors, HTML table extraction and
incremental season landing.  Every operator takes and returns a
``pyspark.sql.DataFrame`` and is parameterised by column names, so the same
code runs on play-by-play files and on the driver's synthetic tables.
"""

__version__ = "0.1.0"
