"""Operators on text measured in tokens of a public tokenizer. Nothing outside this subpackage imports it."""
