"""Operators of the problems tagged llm. Nothing outside this package imports them."""
