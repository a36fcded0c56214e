"""Change-event pipelines on Spark: decode, filter, re-encode, and keep a keyed edits table."""

__version__ = "0.1.0"
