"""Row-level features and tests of the silver tables."""

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

BUY_METHOD = "/buyItem"  # fixed value
LABELLED_CHAMPION = "VIKTOR"  # fixed value


def pseudonym(account, salt: str | None = None) -> Column:
    """SHA-256 hex of the account name, optionally salted; NULL stays NULL."""
    column = F.col(account) if isinstance(account, str) else account
    if salt is not None:
        column = F.concat(F.lit(salt), column)
    return F.sha2(column, 256)


def buy_flag() -> Column:
    return F.when(F.col("method") == BUY_METHOD, 1).otherwise(0)


def champion_label() -> Column:
    return F.when(F.col("champion") == LABELLED_CHAMPION, 1).otherwise(0)


def x_plus_y() -> Column:
    """Sum of the coordinates; NULL, not a failed job, when it leaves the int range."""
    return F.try_add(F.col("x"), F.col("y"))


def step_distance() -> Column:
    """Rounded Euclidean distance from (prev_x, prev_y) to (x, y)."""
    dx = F.col("x").cast("double") - F.col("prev_x")
    dy = F.col("y").cast("double") - F.col("prev_y")
    return F.round(F.sqrt(dx * dx + dy * dy))


def share(part, whole) -> Column:
    """part / whole rounded to two places; NULL for an empty whole."""
    return F.round(F.try_divide(F.col(part), F.col(whole)), 2)


def has_text(name: str) -> Column:
    """True when the text column is neither NULL nor empty; never NULL."""
    return F.coalesce(F.col(name) != "", F.lit(False))


def keep_any() -> Column:
    """True when at least one of the identity columns has text.

    The rule this stands for also ORs blank tests of the int and timestamp
    columns against '', which can never be true.
    """
    return reduce(or_, [has_text(c) for c in ("champion", "encrypted_account", "room_id")])


def keep_all() -> Column:
    """True when all five checked columns are present."""
    present = [has_text(c) for c in ("champion", "encrypted_account", "room_id")]
    present += [F.col(c).isNotNull() for c in ("current_time", "datetime")]
    return reduce(and_, present)
