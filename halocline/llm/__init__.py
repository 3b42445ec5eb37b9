"""Training-data operators over ``documents``, ``pages``, ``benchmark`` and ``labels``.

Nothing else in the package imports this subpackage.
"""
