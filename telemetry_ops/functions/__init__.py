"""Scalar column functions shared by the operators."""

from telemetry_ops.functions.scalar import (  # noqa: F401
    band, fixed_text, lcg, missing_to_null, nan_to_null, python_round, ratio, signed_text,
)
