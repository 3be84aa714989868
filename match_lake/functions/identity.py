"""Player identity: game name and tag line, stable across API keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "#"
BLANKS = " \t\n\r\x0b\x0c"


def player_identity(game_name: str | Column = "game_name", tag_line: str | Column = "tag_line") -> Column:
    """`name#tag`; NULL when either part is, since half a name identifies nobody."""
    return F.concat(game_name if isinstance(game_name, Column) else F.col(game_name), F.lit(SEPARATOR),
                    tag_line if isinstance(tag_line, Column) else F.col(tag_line))


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(BLANKS))


def split_identity(identity: Column) -> tuple[Column, Column]:
    """(game name, tag line), cut at the first separator; no separator, empty tag."""
    at = F.instr(identity, SEPARATOR)
    name = F.when(at > 0, F.substr(identity, F.lit(1), at - 1)).otherwise(identity)
    tag = F.when(at > 0, F.substr(identity, at + 1)).otherwise(F.lit(""))
    return name, tag
