"""Training-data operators: ten corpus-scale building blocks and their registered queries.

Nothing outside this subpackage imports it; deleting the folder leaves the rest of
the library working.
"""
