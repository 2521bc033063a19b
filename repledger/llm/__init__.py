"""Operators for training data, with their queries; nothing else in the library imports this folder."""
