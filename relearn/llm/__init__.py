"""Training-data operators: language, duplicates, quality, licences, toxicity, language model, pieces.

Self-contained: nothing else in the library imports this package.
"""
