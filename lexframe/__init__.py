"""lexframe: legal-document collections as Spark DataFrames.

Sources, span and sequence operators, quality checks and incremental plans over
document listings, fetched records and labelled text.
"""

__version__ = "0.1.0"
