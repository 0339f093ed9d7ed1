"""tidepool: data curation operators on Spark DataFrames.

Validation, cleaning, profiling, fixity, extent, vocabulary, metadata records
and audit scoring, expressed as DataFrame/SQL plans over many datasets at once.
"""

__version__ = "0.1.0"
