"""Training-data operators for text corpora, one module each.

Every operator takes a DataFrame and column names, reads only those columns (others,
whatever their names, don't matter) and returns one row per input row unless its
docstring says otherwise.
"""
