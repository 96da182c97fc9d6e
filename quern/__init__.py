"""Corpus curation on Spark: building, cleaning, scoring and reshaping text and HTML corpora."""
