"""Deterministic stand-ins for remote services, used by registered queries.

They sit in a module of their own (no registry imports) because Python workers
import them when unpickling the UDFs that call them.
"""

from __future__ import annotations

import json

from ..operators.score import ScorerApiError
from ..schemas import OFFERED_TYPES


def rule_scorer(prompt: str) -> str:
    """A deterministic stand-in for a remote model, keyed on the prompt length."""
    n = len(prompt)
    if n % 23 == 0:
        raise ScorerApiError("ThrottlingException: rate exceeded")
    if n % 29 == 0:
        raise ValueError("connection reset")
    return json.dumps({"predicted_type": OFFERED_TYPES[n % 10], "confidence_score": (n % 101) / 100,
                       "reasoning": f"length {n}"})


def flaky_service(data: bytes) -> str:
    """Stand-in OCR service: refuses payloads whose size is a multiple of 5."""
    if len(data) % 5 == 0:
        raise RuntimeError("service unavailable")
    return data.decode("utf-8")


def local_decoder(data: bytes) -> str:
    return data.decode("utf-8")

