"""Streaming: the product this library follows has no streaming operators, so there are none here.

Its late data is handled by availability dates in ``tidewatch.operators.asof``.
"""
