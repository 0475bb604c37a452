"""Small scalar rules shared by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values
BLOCKED_CARD = "1234-1234-1234-1234"
DENIED_CARD_PREFIX = "0"
ENGINEERS = ("Bob", "Alice")
EMAILS = {"Bob": "bob@gmail.com", "Alice": "alice@gmail.com"}
TICKET_PREFIXES = ("[P0]", "[P1]", "[P2]", "[P3]")
MIN_VOTING_AGE = 18


def on_call(ts: Column, engineers: Sequence[str]) -> Column:
    """Who is on call: engineers take turns by day since the epoch."""
    turn = F.pmod(F.unix_date(F.to_date(ts)), F.lit(len(engineers)))
    return F.element_at(F.array(*map(F.lit, engineers)), turn + 1)


def payment_status(card: Column) -> Column:
    return F.when(card == BLOCKED_CARD, "Forbidden").otherwise("OK")


def card_denied(card: Column) -> Column:
    return card.startswith(DENIED_CARD_PREFIX)


def ticket_class(message: Column) -> Column:
    """0 is the most urgent class, 4 is a message without a known prefix."""
    rank = F.lit(len(TICKET_PREFIXES))
    for i, prefix in reversed(list(enumerate(TICKET_PREFIXES))):
        rank = F.when(message.startswith(prefix), i).otherwise(rank)
    return rank
