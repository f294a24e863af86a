"""I-Match fingerprints, with DataFrame operations only.

The lexicon is the terms whose share of the documents lies in a band (a band of inverse document frequencies). A
document's terms in the lexicon, distinct and sorted, are hashed once for each of several randomised subsets of the
lexicon: an edit changes the hashes of the subsets that hold a changed term and leaves the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

#: The band: terms in at least LEAST_SHARE and at most MOST_SHARE of the documents. A document has D distinct terms on
#: average, so at most D / LEAST_SHARE terms reach the lower end, however many documents there are.
LEAST_SHARE, MOST_SHARE = 1 / 500, 1 / 10
#: Up to so many terms the lexicon is a set within the expression, which every task holds; beyond it a table that is joined.
SET_TERMS = 50_000
#: Subsets of the lexicon: SAME_RATE subsets for each rate, a subset of rate 2**-bits holding that share of the lexicon.
#: Dense subsets tell short texts apart, sparse ones leave long texts something in common after an edit.
RATES, SAME_RATE = (4, 6, 8, 10), 16
SUBSETS = len(RATES) * SAME_RATE
#: A subset's hash in a fingerprint, in hexadecimal digits; that of a subset without terms is NONE.
DIGITS = 8
NONE = "0" * DIGITS
#: Documents are dealt into ranges of about this many ids to find each one's successor.
RANGE_ROWS = 50_000


def terms(text: Column) -> Column:
    """Distinct lower-cased terms: runs of letters and digits; an empty one may be among them."""
    return F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """(term, df) of the terms in the band, counted over all rows of docs."""
    n = docs.count()
    # the outer generators keep the optimizer from computing the arrays a second time, for a filter on their size
    df = docs.select(F.explode_outer(terms(F.col("text"))).alias("term")).where("term <> ''").groupBy("term").agg(F.count("*").alias("df"))
    return materialize(df.where((F.col("df") >= F.lit(least * n)) & (F.col("df") <= F.lit(max(most * n, 1.0)))), "lexicon")


def subset_hashes(own: Column, digest: Column) -> Column:
    """SUBSETS hashes for a sorted array of terms.

    The md5 of a term draws its subsets: of three hexadecimal digits for each rate, the first two decide whether it is in
    one at all, the third in which. A text without any term of the lexicon has hashes of its digest, so that it equals
    its copies only.
    """
    short = lambda s: F.substring(F.md5(s), 1, DIGITS)
    drawn = F.transform(own, lambda t: F.struct(t.alias("t"), F.substring(F.md5(t), 1, 3 * len(RATES)).alias("d")))

    def of_rate(all_terms: Column, i: int, bits: int) -> Column:
        limit = format(256 >> (bits - 4), "02x") if bits > 4 else "g"  # as text above all digits
        chosen = F.filter(all_terms, lambda x: F.substring(x.d, 3 * i + 1, 2) < limit)
        placed = F.transform(chosen, lambda x: F.struct(x.t.alias("t"), F.substring(x.d, 3 * i + 3, 1).alias("k")))
        every = F.array(*(F.lit(format(k, "x")) for k in range(SAME_RATE)))
        # the array of an array binds the rate's terms to a variable, so that they are computed once
        subsets = F.flatten(F.transform(F.array(placed), lambda xs: F.transform(every, lambda k: F.filter(xs, lambda x: x.k == k))))
        return F.transform(subsets, lambda xs: F.when(F.size(xs) == 0, F.lit(NONE)).otherwise(short(F.array_join(xs.t, " "))))

    full = F.transform(F.array(drawn), lambda ts: F.concat(*(of_rate(ts, i, bits) for i, bits in enumerate(RATES))))[0]
    empty = F.transform(F.sequence(F.lit(1), F.lit(SUBSETS)), lambda k: short(F.concat_ws(":", k, digest)))
    return F.when(F.size(own) == 0, empty).otherwise(full)


def packed(hashes: Column) -> Column:
    """Hashes as bytes."""
    return F.unhex(F.array_join(hashes, ""))


def likeness(a: Column, b: Column) -> Column:
    """The share of equal hashes among the subsets in which one of two fingerprints (bytes) has terms; 1 for equal ones."""
    size, none = DIGITS // 2, F.lit(bytes(DIGITS // 2))
    every = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    pairs = F.transform(every, lambda k: F.struct(F.substring(a, k * size + 1, F.lit(size)).alias("a"), F.substring(b, k * size + 1, F.lit(size)).alias("b")))
    either = F.filter(pairs, lambda p: (p.a != none) | (p.b != none))
    # the array of an array binds the pairs to a variable, so that they are made once
    share = F.transform(F.array(either), lambda ps: F.try_divide(F.size(F.filter(ps, lambda p: p.a == p.b)).cast("double"), F.size(ps).cast("double")))[0]
    return F.when(a == b, 1.0).otherwise(F.coalesce(share, F.lit(0.0)))


def successors(ids: DataFrame) -> DataFrame:
    """(k, next) for the distinct k of ids in descending order, null last, the last one followed by the first; next: struct<k>.

    Ranges of ids are numbered by a range partitioning that is written down; a range's last id is followed by the first
    one of the next range, found among one row for each range.
    """
    own = materialize(ids.select("k").distinct(), "ids")
    n = max(1, -(-own.count() // RANGE_ROWS))
    ranged = materialize(own.repartitionByRange(n, F.desc_nulls_last("k")).select("k", F.spark_partition_id().alias("part")), "ranged")
    inside = Window.partitionBy("part").orderBy(F.desc_nulls_last("k"))
    led = ranged.withColumn("next", F.lead(F.struct("k")).over(inside))
    heads = ranged.groupBy("part").agg(F.struct(F.max("k").alias("k")).alias("head"))  # null only where a range has no id
    order = Window.partitionBy(F.lit(0)).orderBy("part")
    first = F.first("head").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    heads = heads.select("part", F.coalesce(F.lead("head").over(order), first).alias("next_head"))
    return led.join(F.broadcast(heads) if n <= 10_000 else heads, "part").select("k", F.coalesce("next", "next_head").alias("next"))


def in_lexicon(rows: DataFrame, words: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """rows, the arrays of terms in the columns names reduced to the terms of words (term), sorted."""
    some = [r[0] for r in words.select("term").limit(SET_TERMS + 1).collect()]
    if not some:
        return rows.withColumns({c: F.array().cast("array<string>") for c in names})
    if len(some) <= SET_TERMS:
        wanted = ", ".join(f"'{t}'" for t in some)  # letters and digits only
        both = F.expr(f"transform(array({', '.join(names)}), ts -> sort_array(filter(ts, t -> t in ({wanted}))))")
        rows = rows.withColumn("_both", both)
        return rows.withColumns({c: F.col("_both")[i] for i, c in enumerate(names)}).drop("_both")
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "terms")
    marked = lambda c, i: F.transform(c, lambda t: F.struct(t.alias("term"), F.lit(i).alias("which")))
    every = F.concat(*(marked(c, i) for i, c in enumerate(names)))
    found = rows.select("_row", F.inline_outer(every)).join(words.select("term"), "term")
    sets = found.groupBy("_row").agg(*(F.sort_array(F.collect_list(F.when(F.col("which") == i, F.col("term")))).alias(f"_s{i}") for i in range(len(names))))
    rows = rows.join(sets, "_row", "left")
    return rows.withColumns({c: F.coalesce(f"_s{i}", F.array().cast("array<string>")) for i, c in enumerate(names)}).drop("_row", *(f"_s{i}" for i in range(len(names))))


def compare_edits(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """op10's columns for each row of docs: its fingerprint, its edited text's and the likeness to that and to the next document's.

    The edited text has its last floor(n_chars / 3) code points replaced by as many first ones of the next document in
    descending order of doc_id (the last is followed by the first, nulls come last and count as one id). Of rows that
    share an id with different texts, the one with the least hash lends its beginning and its fingerprint to the one
    before. Repeated rows are rows of their own. Null text is empty, long texts are taken whole. Other columns are not
    read; an empty table gives an empty one.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    words = lexicon(texts.select("text"), least, most)
    rows = materialize(texts.groupBy("k").agg(F.floor(F.max(F.char_length("text")) / 3).cast("int").alias("take")), "ids")
    follow = materialize(successors(rows), "follow")
    # how much of a document its predecessor needs at most
    before = follow.alias("f").join(rows.alias("r"), F.expr("f.k <=> r.k")).select(F.col("f.next.k").alias("lender"), F.col("f.k").alias("to_k"), "take")
    beginning = texts.select(F.col("k").alias("lk"), "text").join(before, F.col("lk").eqNullSafe(F.col("lender")))
    lent = beginning.select("to_k", F.xxhash64("text").alias("h"), F.expr("substring(text, 1, take)").alias("start"))
    lent = lent.groupBy("to_k").agg(F.min(F.struct("h", "start")).alias("l")).select("to_k", F.col("l.start").alias("lent"))
    n = F.char_length("text")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 3) as int))"), F.substring("lent", F.lit(1), F.floor(n / 3).cast("int")))
    both = texts.join(lent, F.col("k").eqNullSafe(F.col("to_k"))).select("k", "text", n.cast("long").alias("n_chars"), edited.alias("edited"))
    own = both.select("k", "n_chars", F.xxhash64("text").alias("h"), F.sha2("edited", 256).alias("sha"), F.md5("text").alias("t"), F.md5("edited").alias("e"), terms(F.col("text")).alias("a"), terms(F.col("edited")).alias("b"))
    own = in_lexicon(own, words, ("a", "b"))
    hashed = own.select("k", "n_chars", "h", "sha", packed(subset_hashes(F.col("a"), F.col("t"))).alias("f"), packed(subset_hashes(F.col("b"), F.col("e"))).alias("g"))
    prints = materialize(hashed, "prints")
    heads = prints.groupBy("k").agg(F.min(F.struct("h", "f")).alias("l")).select(F.col("k").alias("hk"), F.col("l.f").alias("next_f"))
    nexts = follow.join(heads, F.expr("next.k <=> hk")).select(F.col("k").alias("to_k"), "next_f")
    out = prints.join(nexts, F.col("k").eqNullSafe(F.col("to_k")))
    shown = lambda c: F.lower(F.hex(c))
    return out.select(
        F.col("k").alias("doc_id"), "n_chars", F.col("sha").alias("edited_sha256"), shown("f").alias("fingerprint"), shown("g").alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g")).alias("near_edited"), likeness(F.col("f"), F.col("next_f")).alias("near_next"),
    )
