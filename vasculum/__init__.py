"""Specimen-record curation on Spark: every operator is DataFrame in, DataFrame out."""
