"""Operators that prepare text for training; nothing outside this folder imports them."""
