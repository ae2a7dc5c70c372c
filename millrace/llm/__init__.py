"""Training-data operators: token files, exact vector search, secrets, toxicity, quality,
token attribution, media columns, near-duplicates, packing and BPE.

Nothing else in the library imports this package. Every operator selects the columns it
names, so other columns, also of clashing names, do not matter. A null text is an empty
text; a null id is an id like any other and sorts first.
"""
