"""Operators and queries of a training-data pipeline. Nothing else imports this."""
