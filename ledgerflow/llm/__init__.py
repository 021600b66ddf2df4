"""Operators for large text corpora that feed model training; nothing else imports this package."""
