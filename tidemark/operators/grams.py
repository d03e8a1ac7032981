"""Find names of any form inside texts, by the rarest stretch of each name.

A name's anchor is, of its stretches of a fixed length (see ``anchor_width``), the one that fewest other names hold. Anchors are the keys of an
equality join with the stretches of the texts, and what stands around a place that has one is compared with the name. So a
stretch that most names share (``table_``) is no key of theirs, and the candidates per place are as few as the
dictionary allows. Most places of a text hold no anchor at all: these are dropped in the scan by a bit map of the
anchors, before anything is unfolded. Texts are cut into blocks in one linear pass; a candidate carries only
its surroundings, as long as the longest name, so texts never move.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_limit, lookup_join
from tidemark.session import row_bytes

#: Characters of an anchor, the longest that fits; a still shorter name is an anchor as a whole. Texts are read once per length.
WIDTHS = (8, 4)
#: Characters of a text that are searched together; no fewer than the longest name.
BLOCK = 1024
#: Bits of the map of anchors, by the names it has to tell apart, at most.
BITS_PER_NAME, MOST_BITS = 64, 1 << 23


def _stretches(text: Column, width: int) -> Column:
    """All stretches of ``width`` characters, one per place, in order; one linear pass, that begins at whole characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?![\uDC00-\uDFFF])(?=(.{{{width}}}))"), F.lit(1))


def anchor_width(name: Column) -> Column:
    width = F.length(name)
    for fixed in sorted(WIDTHS):
        width = F.when(F.length(name) >= fixed, F.lit(fixed)).otherwise(width)
    return width


def anchors(names: DataFrame) -> DataFrame:
    """(name, width, anchor, before): each name's rarest stretch, and how many characters of the name stand before it.

    Names that share a stretch are counted with a map-side step; ties go to the smaller stretch, then the first place.
    """
    own = names.withColumn("width", anchor_width(F.col("name")))
    widths = [r["width"] for r in own.select("width").distinct().collect()]  # five at most
    found = F.array().cast("array<string>")
    for width in widths:
        found = F.when(F.col("width") == width, _stretches(F.col("name"), width)).otherwise(found)
    each = own.select("name", "width", F.posexplode(found).alias("before", "anchor"))
    holders = each.select("name", "anchor").distinct().groupBy("anchor").agg(F.count(F.lit(1)).alias("holders"))
    rarest = each.join(holders, "anchor").groupBy("name", "width").agg(F.min(F.struct("holders", "anchor", "before")).alias("best"))
    return rarest.select("name", "width", F.col("best.anchor").alias("anchor"), F.col("best.before").alias("before"))


def _slot(anchor: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(anchor), F.lit(bits)).cast("int")


def _bit_map(keys: DataFrame, names: int) -> tuple[Column, int]:
    """A literal with a bit set per anchor, and its number of bits."""
    bits = 64
    while bits < min(names * BITS_PER_NAME, MOST_BITS):
        bits *= 2
    words = keys.select(_slot(F.col("anchor"), bits).alias("slot")).distinct()
    words = words.groupBy(F.floor(F.col("slot") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot") % 64)).alias("set")
    )
    found = np.zeros(bits // 64, np.int64)
    for row in words.collect():  # at most MOST_BITS / 64
        found[row["word"]] = row["set"]
    return F.lit(found), bits


def contains_join_plain(
    names: DataFrame, texts: DataFrame, name_col: str = "name", text_col: str = "text", id_cols: list[str] | None = None
) -> DataFrame:
    """Every pair of a name and a text that contains it, with the 1-based place of the first occurrence, for names of any form.

    Output and rules are those of ``matching.contains_join``, which is the cheaper way where every name holds a dot: the
    id columns, ``name``, ``match_location``, ``name_length``; by substring, case-sensitive; NULL and empty names match nothing.
    Ids may be NULL or repeat: each different text of an id is matched on its own, equal texts of an id count once.
    """
    ids = id_cols or ["id"]
    dictionary = names.select(F.col(name_col).alias("name")).where(F.length("name") > 0).distinct()
    about = dictionary.agg(
        F.count(F.lit(1)).alias("names"),
        F.coalesce(F.max(F.length("name")), F.lit(1)).alias("longest"),
        F.coalesce(F.sum(row_bytes(dictionary)), F.lit(0)).alias("bytes"),
        F.collect_set(anchor_width(F.col("name"))).alias("widths"),
    ).first()
    small = 2 * about["bytes"] <= broadcast_limit(names)  # an anchor is no longer than its name
    longest = about["longest"]
    size = max(BLOCK, longest)
    keyed = anchors(dictionary)
    known, bits = _bit_map(keyed, about["names"])

    text = texts.select(*ids, F.xxhash64(text_col).alias("_text_key"), F.col(text_col).alias("_text"))
    row = [*ids, "_text_key"]
    pieces = F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    cut = text.where(F.length("_text") > 0).select(*row, pieces.alias("_pieces"))

    def surroundings(n: Column) -> Column:
        """A piece between the end of the one before and the beginning of the next, ``longest`` characters each."""
        near = [F.coalesce(F.get("_pieces", n + step), F.lit("")) for step in (-1, 0, 1)]
        return F.concat(F.right(near[0], F.lit(longest)), near[1], F.left(near[2], F.lit(longest)))

    blocks = cut.select(*row, F.explode(F.sequence(F.lit(0), F.size("_pieces") - 1)).alias("_n"), "_pieces")
    blocks = blocks.select(
        *row, surroundings(F.col("_n")).alias("_block"), (F.col("_n") * size).alias("_at"),
        F.when(F.col("_n") > 0, longest).otherwise(0).alias("_lead"), F.length(F.get("_pieces", F.col("_n"))).alias("_own"),
    )

    def candidates(width: int) -> Column:
        places = F.transform(_stretches(F.col("_block"), width), lambda s, at: F.struct(at.alias("at"), s.alias("anchor")))

        def likely(s: Column) -> Column:
            slot = _slot(s["anchor"], bits)
            mine = s["at"].between(F.col("_lead"), F.col("_lead") + F.col("_own") - 1)  # each place belongs to one block
            return mine & (F.bit_get(F.get(known, F.floor(slot / 64).cast("int")), slot % 64) == 1)

        return F.filter(places, likely)

    found = F.concat(*[candidates(w) for w in sorted(about["widths"])]) if about["widths"] else F.array().cast("array<struct<at:int,anchor:string>>")
    places = blocks.select(*row, "_at", "_lead", "_block", F.explode(found).alias("_p"))
    start = F.greatest(F.col("_p.at") - longest, F.lit(0))
    places = places.select(
        *row, F.col("_p.anchor").alias("anchor"), (F.col("_at") - F.col("_lead") + F.col("_p.at")).alias("_place"),
        (F.col("_p.at") - start).alias("_inner"), F.substring("_block", start + 1, F.lit(2 * longest)).alias("_near"),
    )
    met = lookup_join(places, keyed.select("anchor", "name", "before"), ["anchor"], small=small)
    same = (F.col("before") <= F.col("_inner")) & (
        F.substring("_near", F.col("_inner") - F.col("before") + 1, F.length("name")) == F.col("name")
    )
    hits = met.where(same).select(*row, "name", (F.col("_place") - F.col("before") + 1).alias("match_location"))
    first = hits.groupBy(*row, "name").agg(F.min("match_location").alias("match_location"))
    return first.select(*ids, "name", "match_location", F.length("name").alias("name_length"))
