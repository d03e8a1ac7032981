"""Personal data in texts: four kinds by their form, and unseen identifiers by their context.

The forms are exact patterns. They are the seeds of a bootstrap: the two words before a seed make a
lexical pattern; patterns and the identifiers that follow them form a graph, and in each round a
pattern is scored by the share of its occurrences that known identifiers follow, and an unknown identifier
by the patterns it follows. Identifiers that score high become known and support further patterns, until
a round finds no more. In the end, what stands behind a trusted pattern and was accepted is marked, though no form fits it.

Everything is a DataFrame expression. Places come from the lengths of what stands between matches.
The patterns take what they can without going back (possessive), so long runs stay linear.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import kept

KINDS = ("email", "ip", "card", "phone")
#: The base forms, written so that no run of characters is read twice.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of a form holds.
SIGNS = {"email": "@", "ip": ".", "phone": "+"}
#: Tokens with a digit that may be identifiers of any kind.
UNSEEN = r"(?<![A-Za-z0-9@._%+()/-])[A-Za-z@._%+()/-]*+[0-9][A-Za-z0-9@._%+()/-]*+"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])){3}$"
#: Two words before a match; what stands further off is not looked at.
LEFT_CHARS, LEFT = 80, r"(\S+\s+\S+)\s+\S{0,3}$"
#: A pattern needs so many different known identifiers, and so large a share of its occurrences.
SUPPORT, TRUST = 3, 0.6
#: An identifier's patterns together must make it so likely; it has so many digits at least.
ACCEPT, DIGITS = 0.6, 4
#: Patterns, each within LEFT_CHARS, that are broadcast at most; more are counted by a shuffle.
BROADCAST = 100_000

#: Matches whose places are summed up together.
BLOCK = 128

SPAN = "struct<start:int,end:int,value:string,left:string>"


def _pairs(text: Column, form: str, matches: Column) -> Column:
    """Each match with what stands between the match before and it."""
    between = F.slice(F.split(text, form, -1), F.lit(1), F.size(matches))
    pairs = F.arrays_zip(between.alias("before"), matches.alias("match"))
    return F.when(F.size(matches) > 0, pairs).otherwise(F.array().cast("array<struct<before:string,match:string>>"))


def _places(pairs: Column) -> Column:
    """The matches with start and end in code points and the end of what stands before each.

    Places are summed up over blocks of matches first, then within each block, so very many matches stay linear.
    """

    def block(first: Column) -> Column:
        return F.slice(pairs, first + 1, F.lit(BLOCK))

    def passed(at: Column, pair: Column) -> Column:
        return at + F.length(pair["before"]) + F.length(pair["match"])

    def next_block(done: Column, first: Column) -> Column:
        start = F.struct(first.alias("first"), done["at"].alias("at"))
        return F.struct(F.aggregate(block(first), done["at"], passed).alias("at"), F.array_append(done["out"], start).alias("out"))

    none = F.array().cast("array<struct<first:int,at:int>>")
    starts = F.aggregate(
        F.sequence(F.lit(0), F.size(pairs) - 1, F.lit(BLOCK)), F.struct(F.lit(0).alias("at"), none.alias("out")), next_block,
        lambda done: done["out"],
    )

    def step(done: Column, pair: Column) -> Column:
        begin = done["at"] + F.length(pair["before"])
        end = begin + F.length(pair["match"])
        span = F.struct(
            begin.alias("start"), end.alias("end"), pair["match"].alias("value"),
            F.right(pair["before"], F.lit(LEFT_CHARS)).alias("left"),
        )
        return F.struct(end.alias("at"), F.array_append(done["out"], span).alias("out"))

    def spans(start: Column) -> Column:
        empty = F.struct(start["at"].alias("at"), F.array().cast(f"array<{SPAN}>").alias("out"))
        return F.aggregate(block(start["first"]), empty, step, lambda done: done["out"])

    placed = F.flatten(F.transform(starts, spans))
    return F.when(F.size(pairs) > 0, placed).otherwise(F.array().cast(f"array<{SPAN}>"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the Luhn sum of a string of digits ends in zero."""
    backwards = F.reverse(digits)

    def doubled(i: Column) -> Column:
        value = F.substring(backwards, i, F.lit(1)).cast("int") * (2 - i % 2)
        return value - F.when(value > 9, 9).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda sum_, i: sum_ + doubled(i).cast("int"))
    return total % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(IP_PARTS)
    if kind == "card":
        n = F.length(_digits(value))
        return F.when(n.between(13, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def base_spans(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` (text, never null, and the columns ``keep``) with an array of spans per kind and ``unseen``, other tokens with digits."""
    none = F.array().cast("array<string>")
    seen = {kind: F.regexp_extract_all("text", F.lit(form), F.lit(0)) for kind, form in FORMS.items()}
    for kind, sign in SIGNS.items():
        seen[kind] = F.when(F.contains("text", F.lit(sign)), seen[kind]).otherwise(none)
    seen["unseen"] = F.regexp_extract_all("text", F.lit(UNSEEN), F.lit(0))
    rows = rows.withColumns({f"_{kind}": matches for kind, matches in seen.items()})
    holds = {kind: partial(_holds, kind) for kind in KINDS} | {"unseen": lambda value: F.length(_digits(value)) >= DIGITS}

    def spans(kind: str) -> Column:
        placed = F.filter(_places(F.col(f"_{kind}")), lambda span: holds[kind](span["value"]))
        return F.when(F.size(f"_{kind}") > 0, placed).otherwise(F.array().cast(f"array<{SPAN}>")).alias(kind)

    # a step of its own each, so that matches are found and tested once
    rows = rows.withColumns({f"_{kind}": F.when(F.exists(f"_{kind}", holds[kind]), F.col(f"_{kind}")).otherwise(none) for kind in seen})
    forms = FORMS | {"unseen": UNSEEN}
    rows = rows.withColumns({f"_{kind}": _pairs(F.col("text"), form, F.col(f"_{kind}")) for kind, form in forms.items()})
    base = [spans(kind) for kind in KINDS]
    unseen = spans("unseen")
    return rows.select(*keep, *base, unseen)


def _text_rows(docs: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    """(row, doc_id, text): ``row`` names a row by id and text, so that rows which share it have the same spans."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    row = F.concat_ws(":", F.col(doc_id).cast("string"), F.hex(F.xxhash64(whole)))
    return docs.select(row.alias("row"), F.col(doc_id).alias("doc_id"), whole.alias("text"), *more)


def _labelled(spans: Column, kind: Column, *more: str) -> Column:
    """Spans as (kind, start, end, ...)."""
    return F.transform(spans, lambda s: F.struct(kind.alias("kind"), s["start"], s["end"], *[s[m].alias(m) for m in more]))


def _pattern(left: Column) -> Column:
    """The two words before a span, in lower case; null where there are not two."""
    words = F.regexp_extract(left, LEFT, 1)
    return F.when(words != "", F.lower(F.regexp_replace(words, r"\s+", " ")))


def occurrences(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, pattern) of base spans, and with a null kind of other tokens with digits."""
    base = [_labelled(F.col(kind), F.lit(kind), "value", "left") for kind in KINDS]
    known = F.flatten(F.array(*[F.col(kind) for kind in KINDS]))
    others = F.filter("unseen", lambda u: ~F.exists(known, lambda s: (s["start"] < u["end"]) & (u["start"] < s["end"])))
    others = _labelled(others, F.lit(None).cast("string"), "value", "left")
    spans = rows.where(F.size(known) + F.size("unseen") > 0).select("row", F.explode(F.concat(*base, others)).alias("s"))
    return spans.select("row", "s.kind", "s.start", "s.end", "s.value", _pattern(F.col("s.left")).alias("pattern")).where(
        "pattern is not null"
    )


def pattern_totals(docs: DataFrame, patterns: DataFrame, text: str) -> DataFrame:
    """(pattern, total): how often each of ``patterns`` occurs in all texts, whatever follows."""
    words = F.split(F.lower(F.col(text).cast("string")), r"\s+")
    pairs = F.arrays_zip(words.alias("a"), F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))).alias("b"))
    found = docs.where(F.col(text).isNotNull()).select(F.explode(pairs).alias("p"))
    found = found.select(F.concat_ws(" ", "p.a", "p.b").alias("pattern"))
    if patterns.count() <= BROADCAST:
        found = found.join(F.broadcast(patterns), "pattern", "left_semi")
        return found.groupBy("pattern").agg(F.count(F.lit(1)).alias("total"))
    return found.groupBy("pattern").agg(F.count(F.lit(1)).alias("total")).join(patterns, "pattern", "left_semi")


def discover(docs: DataFrame, seen: DataFrame, text: str = "text") -> DataFrame | None:
    """(row, kind, start, end): identifiers that trusted patterns mark; None if no pattern is trusted.

    A pattern is scored for a kind by the share of its occurrences that known identifiers of the kind
    follow; an identifier by the chance that at least one of its patterns is right. Each round takes
    the patterns that known identifiers support by then, and counts in the texts only those that are
    new. What is known never shrinks, so the rounds end.
    """
    edges = kept(seen.groupBy("pattern", "value").agg(F.max("kind").alias("kind"), F.count(F.lit(1)).alias("n")))
    known = kept(edges.where("kind is not null").select("value", "kind").distinct())
    free = edges.where("kind is null").select("pattern", "value", "n")
    # a pattern that no unknown identifier follows can mark nothing
    usable = kept(free.select("pattern").distinct())
    linked = edges.drop("kind").join(usable, "pattern", "left_semi")
    accepted = trusted = totals = None
    while True:
        followed = linked.join(known, "value").groupBy("pattern", "kind")
        scores = followed.agg(F.sum("n").alias("hits"), F.countDistinct("value").alias("support"))
        scores = kept(scores.where(F.col("support") >= SUPPORT))
        new = scores.select("pattern").distinct()
        new = kept(new if totals is None else new.join(totals, "pattern", "left_anti"))
        if not new.isEmpty():
            counted = kept(pattern_totals(docs, new, text))
            totals = counted if totals is None else totals.unionByName(counted)
        if totals is None:
            return None
        scores = scores.join(totals, "pattern").withColumn("trust", F.least(F.col("hits") / F.col("total"), F.lit(0.999)))
        trusted = kept(scores.where(F.col("trust") >= TRUST).select("pattern", "kind", "trust"))
        if trusted.isEmpty():
            return None
        chance = (1 - F.exp(F.sum(F.log(1 - F.col("trust"))))).alias("chance")
        likely = free.join(trusted, "pattern").groupBy("value", "kind").agg(chance).where(F.col("chance") >= ACCEPT)
        best = likely.groupBy("value").agg(F.max(F.struct("chance", F.col("kind"))).alias("best"))
        accepted = kept(best.select("value", "best.kind"))
        grown = kept(known.unionByName(accepted).distinct())
        if grown.count() == known.count():
            break
        known = grown
    marked = seen.where("kind is null").drop("kind").join(accepted, "value")
    return marked.join(trusted, ["pattern", "kind"], "left_semi").select("row", "kind", "start", "end").distinct()


def _listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(parts, ",")


def _base(rows: DataFrame) -> Column:
    """The base spans of all kinds as (kind's number, start, end), in that order."""
    return F.concat(*[_labelled(F.col(kind), F.lit(number)) for number, kind in enumerate(KINDS)])


def _with_found(rows: DataFrame, found: DataFrame | None) -> DataFrame:
    """``rows`` with the column ``found``: the spans that the method adds."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    if found is None:
        return rows.withColumn("found", none)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    lists = found.groupBy("row").agg(F.collect_list(F.struct(order.alias("kind"), "start", "end")).alias("found"))
    return rows.join(lists, "row", "left").withColumn("found", F.coalesce("found", none))


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_found.

    ``spans`` lists kind:start:end (code points, end exclusive) by kind, then start, joined by commas;
    ``base_sha256`` is the SHA-256 of such a list of the base spans, which the four numbers count.
    ``n_found`` counts the spans that the method adds. A null text counts as empty: no spans. Rows that
    repeat an id each get a row; a null id stays null; an empty table gives no rows. Other columns
    are not read.
    """
    rows = kept(base_spans(_text_rows(docs, doc_id, text), ("row", "doc_id")))
    rows = _with_found(rows, discover(docs, kept(occurrences(rows)), text))
    base = _base(rows)
    return rows.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat(base, F.col("found")))).alias("spans"),
        F.size("found").cast("long").alias("n_found"),
    )


def mask_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs``, all rows and columns, with each span of the text replaced by its kind in brackets.

    Spans that overlap are replaced together by the kind of the first. A null text stays null.
    """
    seen = kept(occurrences(base_spans(_text_rows(docs, doc_id, text), ("row",))))
    found = discover(docs, seen, text)
    rows = _text_rows(docs, doc_id, text, F.struct("*").alias("whole"))
    rows = _with_found(base_spans(rows, ("row", "text", "whole")), found)
    spans = F.array_sort(F.transform(F.concat(_base(rows), F.col("found")), lambda s: F.struct(s["start"], s["end"], s["kind"])))
    names = F.array(*[F.lit(f"[{kind.upper()}]") for kind in KINDS])
    rows = rows.withColumn("spans", spans)

    def step(done: Column, s: Column) -> Column:
        before = F.substring("text", done["at"] + 1, s["start"] - done["at"])
        out = F.when(s["start"] >= done["at"], F.concat(done["out"], before, F.get(names, s["kind"]))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate("spans", start, step, lambda done: F.concat(done["out"], F.substring("text", done["at"] + 1, F.length("text"))))
    masked = F.when(F.size("spans") > 0, masked).otherwise(F.col("text"))
    columns = [
        F.when(F.col(f"whole.`{c}`").isNotNull(), masked).alias(c) if c == text else F.col(f"whole.`{c}`") for c in docs.columns
    ]
    return rows.select(*columns)
