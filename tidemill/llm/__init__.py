"""Operators for preparing training data. Nothing else in tidemill imports this."""
