"""Operators of a training-data pipeline over the tables documents, pages, benchmark, labels, conversations.

Each module holds one operator with its own interface and states there what
nulls, empty inputs, ties and repeated rows give; ``queries`` registers them.
"""
