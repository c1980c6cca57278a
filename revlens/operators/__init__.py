"""Relational operators.  Each is a lazy ``DataFrame(s), params -> DataFrame``
function; none triggers a Spark action (FP-Growth ``fit`` is the exception)."""
