"""Spark-native record curation: ordered stages over text or structure records, one audited record per input."""
