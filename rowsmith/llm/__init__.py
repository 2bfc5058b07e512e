"""Operators for preparing training text: near duplicates, tokens, classifiers, quality rules, shards and mixtures."""
