"""Operators for preparing language-model training data on Spark.

One module per operator; ``queries`` holds the registered queries. Nothing
else in the library imports this subpackage.
"""
