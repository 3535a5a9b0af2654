"""Training-data operators: ten corpus operations and the corpus pipeline.

Nothing else in the library imports this subpackage; it may import general
helpers of the library.
"""
