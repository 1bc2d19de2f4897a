"""Operators on corpora of texts, in tokens of a public tokenizer. Nothing else in this package imports them."""
