"""Training-data operators: filtering, deduplication, tokenising, packing and archive formats.

One module per operator; `queries` registers them. Nothing else in the library imports this package.
"""
