"""Operators for preparing language-model training data.

One module per operator, ``queries.py`` registers them. Nothing outside this
package imports it; ``__spark_entry__.py`` adds the queries when it is present.
"""
