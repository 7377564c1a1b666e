"""Longest-first, non-overlapping dictionary matching of terms in texts.

Candidates come from a join of texts and terms; the greedy choice among them is
a fold over an array in each row's group, ordered by length and rank.  The
glossary is broadcast only while its number of terms is within a checked bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomline.functions.text import preserves

#: Terms that are broadcast to every task; more of them are shuffled.
MAX_BROADCAST = 100_000

MARKED = r"<start>.*?<end>"


def ranked(terms: DataFrame) -> DataFrame:
    """Terms with ``n``, their length, and ``rank``: long ones first, then by id.

    Numeric ids are ordered as numbers.  The glossary is the small side: one
    partition orders it.
    """
    number = F.expr("try_cast(term_id as bigint)")
    order = Window.orderBy(F.desc("n"), F.coalesce(number, F.lit(10**12)), "term_id")
    return terms.withColumn("n", F.length("term_src")).withColumn("rank", F.row_number().over(order))


#: Salts over which the texts of a key are spread where terms are not broadcast.
SALTS = 16


def candidates(texts: DataFrame, terms: DataFrame, text: str = "src", bound: int = MAX_BROADCAST) -> DataFrame:
    """Each text with each term that it contains.

    Texts meet terms by equal first characters: the distinct pairs of
    neighbouring characters of a text are joined with the first two of a term,
    and what meets is tested whole.  The terms are broadcast within the bound;
    beyond, numbers of texts meet terms over salted keys, and the texts come back
    by their number, so that a frequent pair of characters copies no text.
    """
    shape = terms.limit(bound + 1).agg(F.count("*").alias("n"), F.min(F.length("term_src")).alias("least")).first()
    keyed = terms.withColumn("__key", F.substring("term_src", 1, 2))
    size = F.length(text)
    # Characters and their neighbours from two arrays: a substring at every place would walk the text each time.
    letters = F.filter(F.split(F.col(text), ""), lambda c: c != "")
    keys = F.zip_with(letters, F.slice(letters, 2, size), lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    if shape["least"] == 1 or shape["n"] > bound:  # terms of one character, or perhaps some
        keys = F.concat(keys, letters)
    some = texts.where(size > 0)
    if shape["n"] <= bound:
        # Outer: else the optimiser makes the array twice, to drop the empty ones first.
        met = some.withColumn("__key", F.explode_outer(F.array_distinct(keys)))
        return met.join(F.broadcast(keyed), "__key").where(F.contains(F.col(text), F.col("term_src"))).drop("__key")
    from loomline.functions.lineage import checkpointed

    numbered = checkpointed(some.withColumn("__row", F.monotonically_increasing_id()))
    meeting = numbered.select("__row", F.pmod("__row", F.lit(SALTS)).cast("int").alias("__salt"), F.explode_outer(F.array_distinct(keys)).alias("__key"))
    spread = keyed.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    pairs = meeting.join(spread, ["__key", "__salt"]).drop("__key", "__salt")
    return numbered.join(pairs, "__row").where(F.contains(F.col(text), F.col("term_src"))).drop("__row")


def positions(text: Column, term: Column, size: Column) -> Column:
    """All places, from 1, where a term begins in a text.

    The text is cut before every place in one pass; the lengths of the parts add up to the places.
    """
    quoted = F.concat(F.lit("(?=\\Q"), F.replace(term, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E)"))
    lengths = F.transform(F.split(text, quoted), F.length)
    state = F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("places"))
    step = lambda s, n: F.struct((s["at"] + n).alias("at"), F.array_append(s["places"], s["at"] + n).alias("places"))
    behind = F.aggregate(F.slice(lengths, 1, F.size(lengths) - 1), state, step, lambda s: s["places"])
    return F.when(F.startswith(text, term), F.concat(F.array(F.lit(1)), behind)).otherwise(behind)


def thinned(places: Column, size: Column) -> Column:
    """The places of a scan from left to right that never looks inside a find."""
    return F.aggregate(
        places, F.slice(places, 1, 0), lambda found, p: F.when((F.size(found) == 0) | (p >= F.element_at(found, -1) + size), F.array_append(found, p)).otherwise(found)
    )


def is_free(taken: Column, p: Column, n: Column) -> Column:
    """Whether the span of ``n`` characters at ``p`` meets none of the taken ones."""
    return ~F.exists(taken, lambda o: (p < o["p"] + o["n"]) & (o["p"] < p + n))


def greedy(spans: Column) -> Column:
    """Spans accepted in order, each only where it meets none before it."""
    return F.aggregate(spans, F.slice(spans, 1, 0), lambda taken, x: F.when(is_free(taken, x["p"], x["n"]), F.array_append(taken, x)).otherwise(taken))


def find_matches(texts: DataFrame, terms: DataFrame, key: str = "segment_id", source: str = "src", target: str = "tgt") -> DataFrame:
    """(key, matches): every accepted occurrence, with whether the target preserves it.

    All occurrences count; a target without the expected text still lets the
    term take its span.  ``matches`` is ordered by place; texts without any give
    no row.  Null and empty texts match nothing; equal keys are one text.
    """
    found = candidates(texts, ranked(terms), source)
    spans = F.transform(
        positions(F.col(source), F.col("term_src"), F.col("n")),
        lambda p: F.struct(F.col("rank").alias("rank"), p.alias("p"), F.col("n").alias("n"), F.col("term_id").alias("term_id"),
                           preserves(F.col(target), F.col("term_tgt")).alias("preserved")),
    )
    grouped = found.withColumn("spans", spans).groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"))
    chosen = F.transform(greedy(F.col("spans")), lambda x: F.struct(
        (x["p"] - 1).alias("start"), (x["p"] + x["n"] - 1).alias("end"), x["term_id"].alias("term_id"), x["preserved"].alias("preserved")
    ))
    return grouped.select(key, F.array_sort(chosen).alias("matches"))


def first_free_terms(texts: DataFrame, terms: DataFrame, key: str = "segment_id", source: str = "src") -> DataFrame:
    """(key, terms): each term at its first place that is still free, ordered by place."""
    found = candidates(texts, ranked(terms), source)
    entry = F.struct("rank", "n", positions(F.col(source), F.col("term_src"), F.col("n")).alias("ps"), "term_id")
    grouped = found.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    none = F.array().cast("array<struct<p:int,n:int,term_id:string>>")

    def take(taken: Column, x: Column) -> Column:
        free = F.get(F.filter(x["ps"], lambda p: is_free(taken, p, x["n"])), F.lit(0))
        return F.when(free.isNotNull(), F.array_append(taken, F.struct(free.alias("p"), x["n"].alias("n"), x["term_id"].alias("term_id")))).otherwise(taken)

    return grouped.select(key, F.transform(F.array_sort(F.aggregate("entries", none, take)), lambda x: x["term_id"]).alias("terms"))


def first_place_terms(texts: DataFrame, terms: DataFrame, key: str = "segment_id", source: str = "src", extra: list[str] | None = None) -> DataFrame:
    """(key, terms): each term at its first place only; taken places drop it.

    ``terms`` keeps the order of acceptance, long ones first, as structs with the
    ``extra`` columns of the term.
    """
    found = candidates(texts, ranked(terms), source)
    span = F.struct("rank", F.instr(F.col(source), F.col("term_src")).alias("p"), "n", "term_id", *(extra or []))
    grouped = found.groupBy(key).agg(F.array_sort(F.collect_list(span)).alias("spans"))
    return grouped.select(key, greedy(F.col("spans")).alias("terms"))


def marked_spans(text: Column) -> Column:
    """Spans (p from 1, n) that markers take already."""
    pieces = F.split(text, MARKED)
    marks = F.regexp_extract_all(text, F.lit(MARKED), F.lit(0))
    none = F.array().cast("array<struct<p:int,n:int>>")
    state = F.struct(F.lit(1).alias("at"), none.alias("spans"))

    def step(acc: Column, i: Column) -> Column:
        begin = acc["at"] + F.length(F.get(pieces, i))
        size = F.length(F.get(marks, i))
        return F.struct((begin + size).alias("at"), F.array_append(acc["spans"], F.struct(begin.alias("p"), size.alias("n"))).alias("spans"))

    return F.when(F.size(marks) > 0, F.aggregate(F.sequence(F.lit(0), F.size(marks) - 1), state, step, lambda acc: acc["spans"])).otherwise(none)


def spliced(text: Column, spans: Column) -> Column:
    """The text with markers around ordered spans."""
    state = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        out = F.concat(acc["out"], F.substring(text, acc["at"], x["p"] - acc["at"]), F.lit("<start>"), F.substring(text, x["p"], x["n"]), F.lit("<end>"))
        return F.struct((x["p"] + x["n"]).alias("at"), out.alias("out"))

    return F.aggregate(spans, state, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"], F.length(text))))


def mark_sources(texts: DataFrame, terms: DataFrame, key: str = "segment_id", source: str = "src") -> DataFrame:
    """The texts with ``marked`` and ``n_marked``: all free occurrences of terms in the source.

    Existing markers keep their spans; texts without a term stay as they are.
    Keys must be unique.
    """
    found = candidates(texts.select(key, source), ranked(terms), source)
    entry = F.struct("rank", "n", thinned(positions(F.col(source), F.col("term_src"), F.col("n")), F.col("n")).alias("ps"))
    grouped = found.groupBy(key, source).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    before = marked_spans(F.col(source))

    def take(taken: Column, x: Column) -> Column:
        free = F.filter(x["ps"], lambda p: is_free(taken, p, x["n"]))
        return F.concat(taken, F.transform(free, lambda p: F.struct(p.alias("p"), x["n"].alias("n"))))

    spans = F.array_sort(F.array_except(F.aggregate("entries", before, take), before))
    chosen = grouped.select(key, spans.alias("spans"))
    joined = texts.join(chosen, key, "left")
    some = F.size("spans") > 0
    return joined.withColumn("marked", F.when(some, spliced(F.col(source), F.col("spans"))).otherwise(F.col(source))).withColumn(
        "n_marked", F.when(some, F.size("spans")).otherwise(0)
    ).drop("spans")


def mark_pairs(texts: DataFrame, terms: DataFrame, key: str = "segment_id", source: str = "src", target: str = "tgt") -> DataFrame:
    """The pairs with both sides marked, and ``n_terms``: terms that have a free
    occurrence on either side; others take no place.  Keys must be unique."""
    found = candidates(texts.select(key, source, target), ranked(terms), source).where(F.contains(F.col(target), F.col("term_tgt")))
    size = F.length("term_tgt")
    entry = F.struct(
        "rank", "n", thinned(positions(F.col(source), F.col("term_src"), F.col("n")), F.col("n")).alias("ps"),
        size.alias("m"), thinned(positions(F.col(target), F.col("term_tgt"), size), size).alias("qs"),
    )
    grouped = found.groupBy(key, source, target).agg(F.array_sort(F.collect_list(entry)).alias("entries"))
    before_src, before_tgt = marked_spans(F.col(source)), marked_spans(F.col(target))
    state = F.struct(before_src.alias("src"), before_tgt.alias("tgt"), F.lit(0).alias("applied"))

    def take(acc: Column, x: Column) -> Column:
        left = F.filter(x["ps"], lambda p: is_free(acc["src"], p, x["n"]))
        right = F.filter(x["qs"], lambda p: is_free(acc["tgt"], p, x["m"]))
        both = F.struct(
            F.concat(acc["src"], F.transform(left, lambda p: F.struct(p.alias("p"), x["n"].alias("n")))).alias("src"),
            F.concat(acc["tgt"], F.transform(right, lambda p: F.struct(p.alias("p"), x["m"].alias("n")))).alias("tgt"),
            (acc["applied"] + 1).alias("applied"),
        )
        return F.when((F.size(left) > 0) & (F.size(right) > 0), both).otherwise(acc)

    folded = grouped.select(key, source, target, F.aggregate("entries", state, take).alias("s"))
    chosen = folded.select(
        key, F.array_sort(F.array_except("s.src", marked_spans(F.col(source)))).alias("__src"),
        F.array_sort(F.array_except("s.tgt", marked_spans(F.col(target)))).alias("__tgt"), F.col("s.applied").alias("n_terms"),
    )
    joined = texts.join(chosen, key, "left")
    return joined.select(
        *texts.columns, F.when(F.size("__src") > 0, spliced(F.col(source), F.col("__src"))).otherwise(F.col(source)).alias("marked_src"),
        F.when(F.size("__tgt") > 0, spliced(F.col(target), F.col("__tgt"))).otherwise(F.col(target)).alias("marked_tgt"),
        F.coalesce("n_terms", F.lit(0)).alias("n_terms"),
    )
