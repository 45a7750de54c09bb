"""Operators of a training-data pipeline: classify, find personal data, score,
de-duplicate, decontaminate, format, encode, pack.  Nothing else in the
library imports this subpackage."""
