"""Null tokens and strict casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

from txvigil.schema import NULL_TOKENS


def null_if_token(text: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Null where the text is one of the tokens."""
    return F.when(~text.isin(*tokens), text)


def checked_cast(value: Column, to: T.DataType, label: str) -> Column:
    """Cast that fails the job on a value that does not fit, with or without ANSI mode."""
    cast = value.try_cast(to)
    complaint = F.raise_error(
        F.concat(F.lit(f"{label}: not a {to.simpleString()}: "), value.cast("string"))
    ).cast(to)
    return F.when(value.isNotNull() & cast.isNull(), complaint).otherwise(cast)
