"""Corpus metrics of translations: BLEU, chrF and terminology preservation.

The clipped n-gram counts of a row are the size of an intersection of two arrays
in which the k-th occurrence of a gram is an element of its own, so no gram is
ever shuffled; only counts are aggregated, by any group columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomline.functions.text import BLANK, no_space, strip, strip_markers
from loomline.operators.matching import first_place_terms


def words(text: Column) -> Column:
    """Words between blanks; an empty text has none."""
    return F.filter(F.split(strip(text), f"{BLANK}+"), lambda t: t != "")


def characters(text: Column) -> Column:
    """Characters but blanks."""
    return F.filter(F.split(no_space(text), ""), lambda t: t != "")


def grams(tokens: Column, order: int) -> Column:
    """All runs of ``order`` tokens, joined; an empty array where there are fewer."""
    count = F.size(tokens) - order + 1
    runs = F.transform(F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(tokens, i, order), "\x1f"))
    return F.when(count >= 1, runs).otherwise(F.array().cast("array<string>"))


def numbered(ordered: Column) -> Column:
    """Sorted items, each with the number of its occurrence.

    Linear where no item repeats; else the cost grows with the square of the
    number of items, which is meant for sentences, not for whole books.
    """
    mark = lambda x, n: F.concat(x, F.lit("\x1e"), n.cast("string"))
    once = F.transform(ordered, lambda x: mark(x, F.lit(0)))
    several = F.transform(ordered, lambda x, i: mark(x, i - F.array_position(ordered, x) + 1))
    return F.when(F.size(F.array_distinct(ordered)) == F.size(ordered), once).otherwise(several)


def gram_counts(df: DataFrame, reference: str, candidate: str, orders: int, tokens, keep: list[str]) -> DataFrame:
    """Per row: lengths, and for each order the clipped, candidate's and reference's gram counts.

    The arrays are made in steps, each a column of its own, so that none is
    computed twice.
    """
    split = df.select(*keep, tokens(F.col(reference)).alias("r"), tokens(F.col(candidate)).alias("c"))
    numbers = range(1, orders + 1)
    ordered = split.select("*", *(F.array_sort(grams(F.col(side), n)).alias(f"{side}_{n}") for n in numbers for side in "rc"))
    named = ordered.select(*keep, "r", "c", *(numbered(F.col(f"{side}_{n}")).alias(f"{side}_{n}") for n in numbers for side in "rc"))
    columns = [F.size("r").alias("r_len"), F.size("c").alias("c_len")]
    for n in numbers:
        columns += [F.size(F.array_intersect(f"c_{n}", f"r_{n}")).alias(f"m{n}"), F.size(f"c_{n}").alias(f"c{n}"), F.size(f"r_{n}").alias(f"r{n}")]
    return named.select(*keep, *columns)


def bleu(
    df: DataFrame, reference: str = "reference", candidate: str = "candidate", group: list[str] | None = None,
    order: int = 4, smoothing: float = 0.1, tokenization: str = "whitespace",
) -> DataFrame:
    """(group, bleu, brevity_penalty, reference_length, candidate_length) over each group's rows.

    Orders without any possible gram are left out; smoothing applies where
    nothing matches; empty candidates count with their reference's length.
    """
    group = group or []
    tokens = {"whitespace": words, "char": characters}[tokenization]
    counts = gram_counts(df, reference, candidate, order, tokens, group)
    sums = counts.groupBy(*group).agg(
        F.sum("r_len").alias("reference_length"), F.sum("c_len").alias("candidate_length"),
        *(F.sum(f"{k}{n}").alias(f"{k}{n}") for n in range(1, order + 1) for k in "mc"),
    )
    logs = [F.when(F.col(f"c{n}") > 0, F.ln(F.when(F.col(f"m{n}") == 0, F.lit(smoothing) / (F.col(f"c{n}") + smoothing)).otherwise(F.col(f"m{n}") / F.col(f"c{n}")))) for n in range(1, order + 1)]
    used = F.array_compact(F.array(*logs))
    mean = F.try_divide(F.aggregate(used, F.lit(0.0), lambda a, x: a + x), F.size(used))
    penalty = (
        F.when(F.col("candidate_length") == 0, 0.0).when(F.col("candidate_length") > F.col("reference_length"), 1.0)
        .otherwise(F.exp(1 - F.try_divide(F.col("reference_length"), F.col("candidate_length"))))
    )
    scored = sums.withColumn("brevity_penalty", penalty).withColumn("bleu", F.when(F.size(used) > 0, F.col("brevity_penalty") * F.exp(mean)).otherwise(0.0))
    return scored.select(*group, "bleu", "brevity_penalty", "reference_length", "candidate_length")


def chrf(df: DataFrame, reference: str = "reference", candidate: str = "candidate", group: list[str] | None = None, order: int = 6, beta: float = 2.0) -> DataFrame:
    """(group, chrf) over each group's rows: mean precision and recall of the orders that occur."""
    group = group or []
    counts = gram_counts(df, reference, candidate, order, characters, group)
    sums = counts.groupBy(*group).agg(*(F.sum(f"{k}{n}").alias(f"{k}{n}") for n in range(1, order + 1) for k in "mcr"))
    zero = F.lit(0.0)
    valid = lambda n: (F.col(f"c{n}") > 0) | (F.col(f"r{n}") > 0)
    ratio = lambda n, k: F.when(valid(n), F.coalesce(F.try_divide(F.col(f"m{n}"), F.col(f"{k}{n}")), zero)).otherwise(zero)
    orders = range(1, order + 1)
    number = sum((valid(n).cast("int") for n in orders), F.lit(0))
    precision = F.coalesce(F.try_divide(sum((ratio(n, "c") for n in orders), zero), number), zero)
    recall = F.coalesce(F.try_divide(sum((ratio(n, "r") for n in orders), zero), number), zero)
    weight = F.lit(beta * beta)
    score = F.coalesce(F.try_divide((1 + weight) * F.col("p") * F.col("q"), weight * F.col("p") + F.col("q")), zero)
    return sums.select(*group, precision.alias("p"), recall.alias("q")).select(*group, score.alias("chrf"))


def status(terms: Column, matched: Column) -> Column:
    """no_terms, all_matched, not_matched or partially_matched."""
    return F.when(terms == 0, "no_terms").when(terms == matched, "all_matched").when(matched == 0, "not_matched").otherwise("partially_matched")


def preservation_rows(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Per row: terms in the source, those that the candidate preserves, with and
    without blanks, and the status of both.  Markers of the candidate do not count."""
    found = first_place_terms(rows.select("row_number", "source"), terms, "row_number", "source", ["term_tgt"])
    joined = rows.join(found, "row_number", "left")
    text = strip_markers(F.col("candidate"))
    bare = no_space(text)
    listed = F.coalesce("terms", F.slice("terms", 1, 0))
    exact = F.size(F.filter(listed, lambda t: F.contains(text, t["term_tgt"])))
    loose = F.size(F.filter(listed, lambda t: F.contains(bare, no_space(t["term_tgt"]))))
    count = F.coalesce(F.size("terms"), F.lit(0))
    some = F.col("terms").isNotNull()
    out = joined.select(
        *rows.columns, F.when(some, count).otherwise(0).alias("n_terms"), F.when(some, exact).otherwise(0).alias("exact"), F.when(some, loose).otherwise(0).alias("nospace"),
    )
    return out.withColumns({"status_exact": status(F.col("n_terms"), F.col("exact")), "status_nospace": status(F.col("n_terms"), F.col("nospace"))})


def preservation(per_row: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Totals of preservation_rows for each group; the rate without any term is 1."""
    group = group or []
    rate = lambda c: F.coalesce(F.try_divide(F.sum(c), F.sum("n_terms")), F.lit(1.0))
    count = lambda c, s: F.count_if(F.col(c) == s)
    return per_row.groupBy(*group).agg(
        F.sum("n_terms").alias("total_terms"), F.sum("exact").alias("matched_exact"), F.sum("nospace").alias("matched_nospace"),
        rate("exact").alias("rate_exact"), rate("nospace").alias("rate_nospace"),
        F.count_if(F.col("n_terms") > 0).alias("rows_with_terms"),
        *(count(c, v).alias(f"rows_{name}{end}") for c, end in (("status_exact", ""), ("status_nospace", "_nospace")) for v, name in (("all_matched", "all"), ("partially_matched", "partial"), ("not_matched", "none"))),
        count("status_exact", "no_terms").alias("rows_without_terms"),
    )


def evaluate(rows: DataFrame, terms: DataFrame, group: list[str]) -> DataFrame:
    """BLEU, chrF, preservation, empty candidates and the composite of each group."""
    empty = rows.groupBy(*group).agg(F.count("*").alias("rows"), F.count_if(F.col("candidate") == "").alias("empty_candidates"))
    kept = preservation(preservation_rows(rows, terms), group)
    joined = empty.join(bleu(rows, group=group), group).join(chrf(rows, group=group), group).join(kept, group)
    return joined.withColumn("composite", 0.5 * F.col("bleu") + 0.5 * F.col("rate_nospace"))


def summary_rows(evaluated: DataFrame, keys: list[str], tokenization: str = "whitespace", order: int = 6, beta: float = 2.0) -> DataFrame:
    """(keys, position, metric, value): the summary of ``evaluate`` in its fixed order, values as text.

    Shares have six digits behind the point.  What was read (``input``) is the
    caller's to add: a table has no path.
    """
    share = lambda c: F.format_string("%.6f", F.col(c).cast("double"))
    number = lambda c: F.col(c).cast("string")
    rows = [("all_terms_matched", "all"), ("partially_matched", "partial"), ("not_matched", "none")]
    listed = [
        ("rows", number("rows")), ("empty_candidate_rows", number("empty_candidates")), ("bleu", share("bleu")), ("bleu_tokenization", F.lit(tokenization)),
        ("bleu_reference_length", number("reference_length")), ("bleu_candidate_length", number("candidate_length")), ("bleu_brevity_penalty", share("brevity_penalty")),
        ("chrf", share("chrf")), ("chrf_max_n", F.lit(str(order))), ("chrf_beta", F.lit(f"{beta:.1f}")),
        ("glossary_preservation_rate", share("rate_exact")), ("glossary_preservation_rate_exact", share("rate_exact")), ("glossary_preservation_rate_nospace", share("rate_nospace")),
        ("glossary_terms", number("total_terms")), ("glossary_terms_matched", number("matched_exact")), ("glossary_terms_matched_exact", number("matched_exact")),
        ("glossary_terms_matched_nospace", number("matched_nospace")), ("rows_with_glossary_terms", number("rows_with_terms")),
        *((f"rows_{name}{end}", number(f"rows_{short}{'_nospace' if end == '_nospace' else ''}")) for end in ("", "_exact", "_nospace") for name, short in rows),
        ("rows_without_glossary_terms", number("rows_without_terms")),
    ]
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("position"), F.lit(m).alias("metric"), v.alias("value")) for i, (m, v) in enumerate(listed, 1))))
    return evaluated.select(*keys, each.alias("x")).select(*keys, "x.position", "x.metric", "x.value")


def long_format(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, value) of every other column."""
    values = [c for c in df.columns if c not in keys]
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in values)))
    return df.select(*keys, pairs.alias("x")).select(*keys, "x.metric", "x.value")


def review_sample(per_row: DataFrame, size: int) -> DataFrame:
    """The first ``size`` rows for review: empty candidates, then rows that miss terms, then the rest."""
    if size <= 0:
        raise ValueError("size must be positive")
    priority = F.when(F.col("candidate") == "", 0).when(F.col("status_exact").isin("not_matched", "partially_matched"), 1).otherwise(2)
    return per_row.withColumn("priority", priority).orderBy("priority", "row_number").limit(size)
