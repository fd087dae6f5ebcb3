"""Property-listing analytics written as Spark DataFrame jobs.

Three table layers - ``ids`` (what exists), ``listings`` (page text and first
numbers) and ``records`` (normalised) - plus document queries and a two-hop
similarity graph.  Everything is a DataFrame expression, join or window.
"""

__version__ = "0.1.0"
