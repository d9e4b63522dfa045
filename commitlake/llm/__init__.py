"""Operators on text and code for training data of language models. Nothing outside this subpackage imports it."""
