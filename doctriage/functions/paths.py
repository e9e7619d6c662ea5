"""Path and URI expressions (D1, D2, D23, suffix routing helpers)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# s3://bucket/key, split at the first slash after the scheme; the key may be empty.
_S3_URI = r"^s3://([^/]*)/([\s\S]*)$"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_s3_uri(uri) -> Column:
    """struct(bucket, key, error): error names the reason when the URI is not usable."""
    u = _c(uri)
    ok = u.rlike(_S3_URI)
    return F.struct(
        F.when(ok, F.regexp_extract(u, _S3_URI, 1)).alias("bucket"),
        F.when(ok, F.regexp_extract(u, _S3_URI, 2)).alias("key"),
        F.when(u.isNull(), F.lit("Invalid S3 URI: None"))
         .when(~u.startswith("s3://"), F.concat(F.lit("Invalid S3 URI: "), u))
         .when(~ok, F.concat(F.lit("Invalid S3 URI format: "), u))
         .alias("error"),
    )


def file_name(path) -> Column:
    """Last path component; trailing slashes and ``.`` components are ignored (as pathlib does)."""
    return F.regexp_extract(F.regexp_replace(_c(path), r"(/+\.?)+$", ""), r"([^/]*)$", 1)


def path_stem(path) -> Column:
    """Name without its last suffix; a leading-dot name is kept whole."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def path_suffix(path) -> Column:
    """Last suffix including the dot, '' when none (same rule as the stem)."""
    return F.regexp_extract(file_name(path), r"(?<=.)(\.[^.]+)$", 1)


def glob_to_regex(pattern: str) -> str:
    """Translate a shell glob (``*``, ``?``, ``[...]``, ``[!...]``) to an anchored Java regex."""
    out, i, n = [], 0, len(pattern)
    while i < n:
        ch = pattern[i]
        i += 1
        if ch == "*":
            out.append("[\\s\\S]*")
        elif ch == "?":
            out.append("[\\s\\S]")
        elif ch == "[":
            j = i
            if j < n and pattern[j] in "!^":
                j += 1
            if j < n and pattern[j] == "]":
                j += 1
            while j < n and pattern[j] != "]":
                j += 1
            if j >= n:
                out.append("\\[")
            else:
                body = pattern[i:j]
                i = j + 1
                neg = body[:1] in ("!", "^")
                if neg:
                    body = body[1:]
                body = body.replace("\\", "\\\\").replace("[", "\\[")
                out.append("[" + ("^" if neg else "") + body + "]")
        else:
            out.append(re.escape(ch))
    return "^" + "".join(out) + "$"


def key_pattern_match(key, pattern: str) -> Column:
    """Object-store pattern: stars are removed and the rest must end the key (suffix match).

    Without ``?``/``[`` this is a plain ``endswith``; otherwise the remaining glob is
    matched against the end of the key.
    """
    if pattern == "*":
        return F.lit(True)
    rest = pattern.replace("*", "")
    k = _c(key)
    if not any(ch in rest for ch in "?["):
        return k.endswith(rest)
    return k.rlike("^[\\s\\S]*" + glob_to_regex(rest)[1:])


def name_glob_match(path, pattern: str) -> Column:
    """Local pattern: a true glob on the file name."""
    if pattern == "*":
        return F.lit(True)
    return file_name(path).rlike(glob_to_regex(pattern))


def prefix_match(key, prefix: str) -> Column:
    return _c(key).startswith(prefix) if prefix else F.lit(True)
