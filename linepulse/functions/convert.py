"""Conversion of message text by the type word the message carries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Type words of the messages and the Spark type each stands for.
# Any other word, other capital letters included, means string.
TYPE_WORDS = {
    "Int": "int",
    "int": "int",
    "Int32": "int",
    "int32": "int",
    "Int64": "bigint",
    "int64": "bigint",
    "Long": "bigint",
    "long": "bigint",
    "Float": "float",
    "float": "float",
    "Double": "double",
    "double": "double",
    "Decimal": "double",
    "decimal": "double",
    "Boolean": "boolean",
    "boolean": "boolean",
}

NUMERIC = ("int", "bigint", "float", "double")


def cast_text(text: Column, to: str) -> Column:
    """Typed value of `text`, NULL when it does not convert."""
    if to == "string":
        return text
    if to == "boolean":
        word = F.lower(text)
        return F.when(word == "true", True).when(word == "false", False)
    return text.try_cast(to)


def words_for(to: str) -> list[str]:
    return [word for word, kind in TYPE_WORDS.items() if kind == to]


def _by_word(text: Column, word: Column, typed, other: Column) -> Column:
    """CASE over the type words; `typed(column, kind)` builds each branch."""
    chain = None
    for kind in (*NUMERIC, "boolean"):
        match = word.isin(words_for(kind))
        branch = typed(cast_text(text, kind), kind)
        chain = F.when(match, branch) if chain is None else chain.when(match, branch)
    return chain.otherwise(other)


def converts(text: Column, word: Column) -> Column:
    """Whether a trimmed, non-blank `text` converts to the type `word` names."""
    return _by_word(text, word, lambda v, _: v.isNotNull(), word.isNotNull())


def json_string(text: Column) -> Column:
    """`text` as a quoted JSON string."""
    wrapped = F.to_json(F.array(text))
    return wrapped.substr(F.lit(2), F.length(wrapped) - 2)


def json_value(text: Column, word: Column) -> Column:
    """`text` as a JSON value of the type `word` names; an empty string if it does not convert."""
    empty = F.lit('""')
    typed = _by_word(
        text, word, lambda v, _: F.coalesce(v.cast("string"), empty), json_string(text)
    )
    return (
        F.when(text.isNull(), empty)
        .when(F.trim(text) == "", json_string(text))
        .when(word.isNull(), empty)
        .otherwise(typed)
    )
