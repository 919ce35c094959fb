"""Message classification and template routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignal import dictionaries as D
from jobsignal import schemas as S
from jobsignal.functions import dom
from jobsignal.functions.scalars import matches_any
from jobsignal.sources.selecting import Pick, Picks

# The automata of mails start with these selectors, so ``mail_type`` reads the hits of any of them.
SIGNS = {f"sign_{i}": Pick(sign) for i, sign in enumerate(D.MAIL_SIGNS)}
MAIL_SIGNS = Picks(**SIGNS)


def is_short_command(text: Column) -> Column:
    """Under ten characters and without a space; the empty text counts."""
    return (F.length(text) < 10) & (F.instr(text, " ") == 0)


def chat_type(text: Column) -> Column:
    """Type id of a chat text; service signs beat statistic signs beat vacancy signs."""
    return (F.when(matches_any(text, D.CHAT_SIGNS["tg_service"]), S.CHAT_SERVICE)
            .when(matches_any(text, D.CHAT_SIGNS["tg_statistic"]), S.CHAT_STATISTIC)
            .when(matches_any(text, D.CHAT_SIGNS["tg_vacancy"]), S.CHAT_VACANCY)
            .when(is_short_command(text), S.CHAT_SERVICE)
            .otherwise(S.CHAT_UNKNOWN))


def mail_type(nodes: Column) -> Column:
    """Type id of a mail from its hits."""
    has_card = dom.any_node(nodes, MAIL_SIGNS.test(*SIGNS))
    return F.when(has_card, S.MAIL_VACANCY).otherwise(S.MAIL_UNKNOWN)


def mail_layout(date: Column) -> Column:
    """0 up to the switch instant (inclusive), 1 after it."""
    return F.when(date <= F.lit(D.LAYOUT_SWITCH).cast("timestamp_ntz"), 0).otherwise(1)


def with_chat_type(messages: DataFrame, text: str = "text") -> DataFrame:
    return messages.withColumn("message_type_id", chat_type(F.coalesce(F.col(text), F.lit(""))))
