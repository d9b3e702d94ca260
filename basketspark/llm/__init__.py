"""Training-data operators: text, page, conversation and mixture operators for very large corpora.

Nothing else in the package imports this subpackage; ``queries.py`` holds its query registry.
"""
