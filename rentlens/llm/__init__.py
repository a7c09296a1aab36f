"""Operators for training data at corpus scale. Nothing outside this folder imports it."""
