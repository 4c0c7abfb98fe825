"""Data-quality checks, feature jobs and distributed models as DataFrame transformations.

Every operator takes and returns Spark DataFrames; nothing here holds a session
of its own. See the README for the map from operator to module.
"""

__version__ = "0.1.0"
