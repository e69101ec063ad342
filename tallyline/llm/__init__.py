"""Training-data operators: one module per operator, `queries` for the
registered digests.  Nothing else in the library imports this subpackage.
"""
