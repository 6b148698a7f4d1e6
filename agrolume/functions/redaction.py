"""Redaction inside JSON documents of any depth."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from agrolume.functions import text

#: Levels of maps and lists that are walked; what lies deeper is redacted whole.
MAX_DEPTH = 20


def redact_json(document: Column) -> Column:
    """A JSON text with the values of secret keys blanked, in maps inside lists inside maps, and other strings cleaned.

    Keys keep their order, numbers and literals stay. A text that is no JSON is cleaned as free text, null stays null.
    """
    hidden, deepest = text.REDACTED, MAX_DEPTH
    patterns = [re.compile(p) for p in text.secret_patterns()]
    secret = re.compile(text.name_pattern(text.SECRET_KEYS, text.SECRET_SUFFIXES))
    signed = re.compile(text.name_pattern(text.SIGNED_PARAMS))
    links = text.LINK_KEYS

    def named_secret(key: str) -> bool:
        bare = re.sub("[^a-z0-9]", "", key.lower())
        return bool(secret.match(key)) or bare in links or ("download" in bare and ("url" in bare or "href" in bare))

    def clean(value: str) -> str:
        if re.match("(?i)[a-z0-9]+://", value) and "?" in value:
            front, mark, fragment = value.partition("#")
            path, _, query = front.partition("?")
            parts = [p.partition("=")[0] + "=" + hidden if signed.match(unquote(p.partition("=")[0])) else p for p in query.split("&")]
            return f"{path}?{'&'.join(parts)}{mark}{fragment}" if "?" in front else value
        for p in patterns:
            value = p.sub(lambda m: m[1] + hidden, value)
        return value

    def walk(value, depth: int):
        if depth > deepest:
            return hidden
        if isinstance(value, dict):
            return {k: hidden if named_secret(k) else walk(v, depth + 1) for k, v in value.items()}
        if isinstance(value, list):
            return [walk(v, depth + 1) for v in value]
        return clean(value) if isinstance(value, str) else value

    def one(document: str | None) -> str | None:
        if document is None:
            return None
        try:
            parsed = json.loads(document)
        except (ValueError, RecursionError):
            return clean(document)
        return json.dumps(walk(parsed, 0), ensure_ascii=False, separators=(",", ":"))

    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(one)

    return redact(document)
