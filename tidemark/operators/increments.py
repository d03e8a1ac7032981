"""Names in texts, kept up to date from run to run.

The matches of a growing log with a changing list of names are a view over both. Here it is maintained: a run
matches the new texts with all names, and the old texts only with names that are new. What was found is stored as narrow
rows that are only ever appended; the list of names, with the run since which each is known without a break, tells
which of them count. A name that goes takes its matches with it, and if it comes back the old texts are searched for it anew.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import moment
from tidemark.operators.joins import lookup_join
from tidemark.operators.matching import by_id, contains_join
from tidemark.session import durable, measured


class Matches(NamedTuple):
    """What a run adds to the stored matches, the names it knows, and all matches that count after it."""

    added: DataFrame
    names: DataFrame
    current: DataFrame


def known_names(names: DataFrame, known: DataFrame, run_ts: dt.datetime, name_col: str = "name") -> DataFrame:
    """(name, since): today's names, with the run that first knew each or, if that was interrupted, knew it again."""
    today = names.select(F.col(name_col).alias("name")).where("name is not null").distinct()
    return today.join(known, "name", "left").select("name", F.coalesce("since", moment(run_ts)).alias("since"))


def additions(
    names: DataFrame, known: DataFrame, old_texts: DataFrame, new_texts: DataFrame, text_col: str, id_cols: list[str]
) -> DataFrame:
    """The matches that no run before has found; old texts are read only if some name is new."""
    fresh = names.join(known, "name", "left_anti")
    added = contains_join(names, new_texts, "name", text_col, id_cols)
    if fresh.isEmpty():
        return added
    return added.unionByName(contains_join(fresh, old_texts, "name", text_col, id_cols))


def matches_after(
    names: DataFrame,
    old_texts: DataFrame,
    new_texts: DataFrame,
    stored: DataFrame,
    known: DataFrame,
    run_ts: dt.datetime,
    name_col: str = "name",
    text_col: str = "querytxt",
    id_cols: tuple[str, ...] = ("query_id",),
) -> Matches:
    """The matches (ids, name, match_location, name_length) of all texts with today's ``names`` after a run.

    ``stored`` and ``known`` are what the runs before left (``added`` of all, ``names`` of the last); ``old_texts`` are the texts
    that they saw. Equals ``contains_join(names, old_texts and new_texts)`` where ids tell texts apart. A stored match counts
    if its name is still known and was so when the match was found. ``current`` is partitioned by the ids, like the
    result of ``contains_join``: all that follows per id needs no further shuffle of the matches.
    """
    today = durable(known_names(names, known, run_ts, name_col))
    added = additions(today, known, old_texts, new_texts, text_col, list(id_cols))
    added = durable(added.withColumn("matched_at", moment(run_ts)))
    every = lookup_join(stored.select(added.columns).unionByName(added), today, ["name"])
    # the length follows from the name, so it does not travel
    current = every.where(F.col("matched_at") >= F.col("since")).select(*id_cols, "name", "match_location")
    current = by_id(current, list(id_cols), stored.count() + measured(added)["rows"])
    return Matches(added, today, current.withColumn("name_length", F.length("name")))
