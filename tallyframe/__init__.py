"""tallyframe: probability tables and mergeable aggregates as Spark DataFrame jobs.

A probability mass function is a long table ``(group keys..., outcome, weight)``; a sketch is a grouped
aggregate; an ordered state fold is a per-key ordered scan. Every operator takes and returns DataFrames and
leaves planning to Catalyst.
"""

__version__ = "0.1.0"
