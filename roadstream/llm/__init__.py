"""Operators for preparing training data: dedup, scans, classifiers, mixing, encoding. Nothing else imports this package."""
