"""Find names inside texts.

The plain form, a join on ``instr(text, name) > 0``, compares every name with every text. Here
each name is an exact join key instead. A name is cut at its first dot into a head and a rest;
wherever it occurs in a text, a dot of the text sits between the two. So for each dot of a text
the candidates are: every ending of what stands before it that has the length of some head, and,
if that ending is a known head, every beginning of what follows that has the length of one of
that head's rests. Candidates that equal a name are exactly the occurrences. The work per dot
depends on the number of distinct lengths, not on the number of names, so a head shared by a
large share of all names costs no more than a rare one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import broadcast_limit, lookup_join
from tidemark.session import row_bytes

DOT = r"\."
#: Dots of a text whose places are summed up together; keeps a text with very many dots linear.
BLOCK = 256
#: Dots of texts whose matches, or matches themselves, that meet in one task. A match takes under 1 KB there, in all steps that
#: follow by id.
DOTS_AT_ONCE = 400_000


def _dots(texts: DataFrame, keep: list[str], rest_dots: int) -> DataFrame:
    """A row per dot of a text: the columns ``keep``, the dot's 1-based place, and what stands on both sides.

    ``before`` reaches back to the previous dot, ``after`` over as many further dots as a name may hold. Places
    are sums of piece lengths, first over blocks of pieces, then within each block.
    """
    cut = texts.select(*keep, F.split("_text", DOT).alias("_pieces")).where(F.size("_pieces") > 1)
    dots = F.size("_pieces") - 1

    def block_length(first: Column) -> Column:
        pieces = F.slice("_pieces", first + 1, F.lit(BLOCK))
        return F.aggregate(pieces, F.lit(0), lambda total, piece: total + F.length(piece) + 1)

    def next_block(done: Column, first: Column) -> Column:
        block = F.struct(first.alias("first"), done["at"].alias("at"))
        return F.struct((done["at"] + block_length(first)).alias("at"), F.array_append(done["out"], block).alias("out"))

    none = F.array().cast("array<struct<first:int,at:int>>")
    starts = F.aggregate(
        F.sequence(F.lit(0), dots - 1, F.lit(BLOCK)), F.struct(F.lit(0).alias("at"), none.alias("out")), next_block,
        lambda done: done["out"],
    )
    blocks = cut.select(*keep, "_pieces", F.explode(starts).alias("_block"))
    pieces = F.slice("_pieces", F.col("_block.first") + 1, F.lit(BLOCK + rest_dots + 1))
    blocks = blocks.select(
        *keep, pieces.alias("_part"), F.col("_block.at").alias("_at"), F.least(F.lit(BLOCK), dots - F.col("_block.first")).alias("_n")
    )

    def next_place(places: Column, piece: Column) -> Column:
        last = F.coalesce(F.try_element_at(places, F.lit(-1)), F.col("_at"))
        return F.array_append(places, last + F.length(piece) + 1)

    places = F.aggregate(F.slice("_part", F.lit(1), F.col("_n")), F.array().cast("array<int>"), next_place)
    each = blocks.select(*keep, "_part", F.posexplode(places).alias("_dot", "place"))
    if rest_dots == 0:
        after = F.element_at("_part", F.col("_dot") + 2)
    else:  # names with further dots reach over as many pieces
        after = F.array_join(F.slice("_part", F.col("_dot") + 2, F.lit(rest_dots + 1)), ".")
    return each.select(*keep, "place", F.element_at("_part", F.col("_dot") + 1).alias("before"), after.alias("after"))


def by_id(matches: DataFrame, ids: list[str], size: int) -> DataFrame:
    """``matches`` partitioned by the id columns, in as many partitions as ``size``, their number or that of the dots, needs.

    A given number keeps adaptive execution from merging partitions: matches are narrow and compress so well that
    what looks small takes gigabytes in the hash tables and sorts that follow. Few matches are left to it.
    """
    needed = -(-size // DOTS_AT_ONCE)
    if needed <= 1:
        return matches.repartition(*ids)
    return matches.repartition(max(needed, int(matches.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *ids)


def contains_join(
    names: DataFrame, texts: DataFrame, name_col: str = "name", text_col: str = "text", id_cols: list[str] | None = None
) -> DataFrame:
    """Every pair of a name and a text that contains it, with the 1-based place of the first occurrence.

    Output: the id columns, ``name``, ``match_location``, ``name_length``; partitioned by the id
    columns, in as many partitions as the dots of the texts need; to count these the texts are read once more. Matching is by
    substring and case-sensitive. Every name must hold a dot. Ids may be NULL
    or repeat: each different text of an id is matched on its own, equal texts of an id count once.
    """
    ids = id_cols or ["id"]
    dictionary = names.select(F.col(name_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    dictionary = dictionary.withColumn("head", F.substring_index("name", ".", 1))
    rest = F.length("name") - F.length("head") - 1
    about = dictionary.agg(
        F.count_if(~F.contains("name", F.lit("."))).alias("dotless"),
        F.coalesce(F.sum(row_bytes(dictionary)), F.lit(0)).alias("bytes"),
        F.collect_set(F.length("head")).alias("head_lengths"),
        F.coalesce(F.max(F.length("name") - F.length(F.replace("name", F.lit("."), F.lit(""))) - 1), F.lit(0)).alias(
            "rest_dots"
        ),
    ).first()
    if about["dotless"]:
        raise ValueError(f"{about['dotless']} names hold no dot")
    # Shapes are no more than names, and mostly far fewer: beyond the limit they are measured on their own.
    small = about["bytes"] <= broadcast_limit(names) or None

    text = texts.select(*ids, F.xxhash64(text_col).alias("_text_key"), F.col(text_col).alias("_text"))
    row = [*ids, "_text_key"]
    sides = _dots(text, row, about["rest_dots"])
    lengths = F.array(*[F.lit(n) for n in sorted(about["head_lengths"])]).cast("array<int>")
    endings = (
        sides.withColumn("_length", F.explode(lengths))
        .where(F.col("_length") <= F.length("before"))
        .select(*row, (F.col("place") - F.col("_length")).alias("match_location"), F.right("before", F.col("_length")).alias("head"), "after")
    )
    shapes = dictionary.select("head", rest.alias("_rest")).distinct()
    known = lookup_join(endings, shapes, ["head"], small=small)
    candidates = known.where(F.col("_rest") <= F.length("after")).select(
        *row, "match_location", F.concat("head", F.lit("."), F.substring("after", F.lit(1), F.col("_rest"))).alias("name")
    )
    hits = lookup_join(candidates, dictionary.select("name"), ["name"], "left_semi", small=bool(small))
    dots = F.length("_text") - F.length(F.replace("_text", F.lit("."), F.lit("")))
    size = text.agg(F.sum(dots.cast("bigint"))).first()[0] or 0
    first = by_id(hits, ids, size).groupBy(*row, "name").agg(F.min("match_location").alias("match_location"))
    return first.select(*ids, "name", "match_location", F.length("name").alias("name_length"))


def longest_match(matches: DataFrame, id_cols: list[str], length_col: str = "name_length") -> DataFrame:
    """Where several names match at the same place of a text, keep the longest.

    Names at one place are beginnings of each other, so a group is no larger than the longest name.
    """
    same_place = Window.partitionBy(*id_cols, "match_location")
    longest = F.max(length_col).over(same_place)
    return matches.withColumn("_longest", longest).where(F.col(length_col) == F.col("_longest")).drop("_longest")
