"""Operators of a training-data pipeline over ``documents``, ``pages``,
``conversations``, ``benchmark`` and ``labels``.

Nothing else in the library imports this package; ``__spark_entry__`` adds its
queries only when the package is present.
"""
