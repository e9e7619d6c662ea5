"""Text expressions: truncation, prompt, previews, Python-style strip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import OFFERED_TYPES, PROMPT_HEAD, PROMPT_MIDDLE, PROMPT_TAIL

# Characters Python's str.strip() removes (str.isspace), as a Java class.
_WS = "[\\s\\x1c-\\x1f\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(text) -> Column:
    """Leading and trailing whitespace removed the way ``str.strip()`` does."""
    return F.regexp_replace(_c(text), f"^{_WS}+|{_WS}+$", "")


def truncate_text(text, limit: int) -> Column:
    """First ``limit`` characters (code points), as a Python slice."""
    return F.substring(_c(text), 1, limit)


def build_prompt(text, offered_types: list[str] | None = None,
                 limit: int | None = None) -> Column:
    """Classification prompt: fixed frame, offered types, whole text, or its first ``limit`` characters."""
    types = ", ".join(offered_types or OFFERED_TYPES)
    return F.concat(F.lit(PROMPT_HEAD + types + PROMPT_MIDDLE),
                    F.coalesce(_c(text) if limit is None else truncate_text(text, limit), F.lit("")),
                    F.lit(PROMPT_TAIL))


def preview(text, n: int) -> Column:
    """First ``n`` characters."""
    return F.substring(_c(text), 1, n)
