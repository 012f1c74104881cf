"""Operators of a training-data pipeline: tokens, HTML, mixing, toxicity, WARC, quality, decontamination,
URL filters, language ID and near-duplicates. Nothing outside this package imports it."""
