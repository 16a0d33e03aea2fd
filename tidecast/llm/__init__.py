"""Operators for building training data for language models; nothing else imports them."""
