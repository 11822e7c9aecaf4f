"""SpotSigs fingerprints, in table operations only.

A text is lower-cased (A-Z) and cut into words. Every common word is an anchor; with the next
``CHAIN`` content words that follow it within ``REACH`` words it forms a signature. The set of a text's
signature hashes, sorted, is what is compared; its digest is the fingerprint. A text without any
signature has its whole word sequence as one, and a text without words has the empty set.

Likeness is the Jaccard index. Sets fall into length classes whose bounds grow by 1/similarity,
so only equal or adjacent classes can reach the similarity, and a pair whose lengths differ too
much is pruned without comparing. ``similar`` joins by (length class or the next, signature): of each set only as many of its
rarest signatures as a pair of that similarity must share one of, and only places in them from which the
similarity can still be reached. ``compare_edited`` takes fixed pairs and gives every likeness, pruning none.
Two empty sets are alike.

Null text counts as empty, a null id as the smallest id. Ties and repeated rows are ordered by
text. Extra columns are left alone. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driverlens.llm.common import words
from driverlens.session import materialize

CHAIN = 2
REACH = 8
SIMILARITY = 0.8
BUCKET_ROWS = 2000  # documents of neighbouring ids that are put side by side
MOST_BUCKETS = 1 << 14  # so that the bounds fit a plan; beyond, buckets hold more documents

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "from", "has", "he", "in", "is", "it", "its", "of", "on", "or", "that", "the", "this", "to", "was", "were", "will", "with",
    "auf", "das", "dem", "den", "der", "des", "die", "ein", "eine", "für", "im", "ist", "mit", "nicht", "sich", "und", "von", "zu",
    "au", "avec", "dans", "de", "du", "elle", "en", "est", "et", "il", "la", "le", "les", "pas", "pour", "que", "qui", "sur", "un", "une",
    "al", "con", "del", "el", "es", "las", "lo", "los", "no", "para", "por", "se", "su", "una", "y",
)


def signatures(text: Column) -> Column:
    """Sorted distinct signature hashes of a word array column."""
    at = F.filter(F.sequence(F.lit(1), F.size(text)), lambda i: F.element_at(text, i).isin(*ANCHORS))

    def chain(i: Column) -> Column:
        following = F.filter(F.slice(text, i + 1, REACH), lambda w: ~w.isin(*ANCHORS))
        return F.concat(F.slice(text, i, 1), F.slice(following, 1, CHAIN))

    spots = F.filter(F.transform(at, chain), lambda c: F.size(c) == CHAIN + 1)
    hashed = F.sort_array(F.array_distinct(F.transform(spots, lambda c: F.xxhash64(c))))
    empty = F.array().cast("array<bigint>")
    found = F.when(F.size(text) > 0, hashed).otherwise(empty)
    return F.when((F.size(found) == 0) & (F.size(text) > 0), F.array(F.xxhash64(text))).otherwise(found)


def fingerprint(sigs: Column) -> Column:
    return F.sha2(F.array_join(sigs.cast("array<string>"), ","), 256)


def length_class(sigs: Column, similarity: float) -> Column:
    """Sets of at least the similarity (above 0, at most 1) lie in equal or adjacent classes."""
    if not 0 < similarity <= 1:
        raise ValueError(f"similarity out of range: {similarity}")
    if similarity == 1:
        return F.size(sigs)
    return F.floor(F.log(F.greatest(F.size(sigs), F.lit(1))) / F.log(F.lit(1 / similarity)) + 1e-9).cast("int")


def likeness(a: Column, b: Column, similarity: float = 0.0) -> Column:
    """Jaccard index of two sorted sets; 0 without comparing where their lengths rule out the similarity."""
    short, long = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    both = F.size(F.array_intersect(a, b))
    index = both / (F.size(a) + F.size(b) - both)
    return F.when(long == 0, F.lit(1.0)).when((short == 0) | (short < long * similarity - 1e-9), F.lit(0.0)).otherwise(index)


def with_signatures(docs: DataFrame, text: str = "text", out: str = "sigs") -> DataFrame:
    """Add the signature set of a text column."""
    return docs.withColumn("_words", words(F.col(text))).withColumn(out, signatures(F.col("_words"))).drop("_words")


def distinct_sets(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """(fingerprint, sigs, length_class), one row per distinct set, and (id, fingerprint) of every row.

    Copies fold into one set on the map side, so a text that a third of the rows hold is compared once.
    """
    made = with_signatures(docs.select(F.col(id).alias(id), F.col(text).alias("_text")), "_text").drop("_text")
    made = made.withColumn("fingerprint", fingerprint(F.col("sigs")))
    sets = made.groupBy("fingerprint").agg(F.first("sigs").alias("sigs"))
    return sets.withColumn("length_class", length_class(F.col("sigs"), similarity)), made.select(id, "fingerprint")


def similar(docs: DataFrame, id: str = "doc_id", text: str = "text", similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """All pairs of different sets that are at least so alike (a, b: fingerprints, a < b; likeness), and (id, fingerprint) of every row.

    Every such pair comes out: two sets of n and m signatures, ordered rarest first, share one of their first
    n - ceil(s n) + 1 and m - ceil(s m) + 1, and their classes are equal or adjacent. A set
    is posted under its class and probes its own and the one above. Sets themselves move for candidates only.
    """
    sets, members = distinct_sets(docs, id, text, similarity)
    sets = materialize(sets, "spot-sets")
    posted = sets.select("fingerprint", "length_class", F.size("sigs").alias("n"), F.explode("sigs").alias("sig"))
    counted = posted.groupBy("sig").agg(F.count("*").alias("sets"))
    shared = posted.join(counted.where(F.col("sets") > 1), "sig", "left")
    ordered = shared.groupBy("fingerprint", "length_class", "n").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("sets", F.lit(1)).alias("sets"), "sig"))).alias("line"))
    first = F.slice("line", 1, F.col("n") - F.ceil(F.col("n") * similarity - 1e-9).cast("int") + 1)
    posts = materialize(
        ordered.select("fingerprint", "length_class", "n", F.posexplode(first).alias("at", "rare")).where("rare.sets > 1").select("fingerprint", "length_class", "n", "at", "rare.sig"),
        "spot-posts",
    )
    probes = posts.withColumn("probed", F.explode(F.array(F.col("length_class"), F.col("length_class") + 1)))
    a, b = posts.alias("a"), probes.alias("b")
    once = (F.col("a.length_class") > F.col("b.length_class")) | (F.col("a.fingerprint") < F.col("b.fingerprint"))
    short, long = F.least("a.n", "b.n"), F.greatest("a.n", "b.n")
    reach = F.least(F.col("a.n") - F.col("a.at"), F.col("b.n") - F.col("b.at"))
    fits = (short >= long * similarity - 1e-9) & (reach >= (F.col("a.n") + F.col("b.n")) * (similarity / (1 + similarity)) - 1e-9)
    met = a.join(b, (F.col("a.sig") == F.col("b.sig")) & (F.col("a.length_class") == F.col("b.probed")) & once & fits)
    names = F.array_sort(F.array("a.fingerprint", "b.fingerprint"))
    pairs = met.select(names[0].alias("a"), names[1].alias("b")).distinct()
    left = sets.select(F.col("fingerprint").alias("a"), F.col("sigs").alias("a_sigs"))
    right = sets.select(F.col("fingerprint").alias("b"), F.col("sigs").alias("b_sigs"))
    alike = pairs.join(left, "a").join(right, "b").select("a", "b", likeness(F.col("a_sigs"), F.col("b_sigs"), similarity).alias("likeness"))
    return alike.where(F.col("likeness") >= similarity), members


def beside_next(docs: DataFrame, id: str, order: list[str], carry: list[str], made: dict[str, Callable[[], Column]] | None = None) -> DataFrame:
    """Add ``next``: a struct of the ``carry`` columns of the row with the next smaller id; after the last, the first.

    Columns ``made`` are added once the rows have moved, so they are computed once a row and never shuffled.

    Ids are cut into buckets at ids that occur, found by approximate percentiles. The row of a bucket's
    largest id is also a guest at the end of the bucket above it, and the largest of all is a guest at the end of
    the lowest. So each bucket is ordered by itself, and rows move once. The number of buckets
    follows the number of rows, up to ``MOST_BUCKETS``; sorting spills.
    """
    place = F.coalesce(F.col(id).cast("bigint"), F.lit(-(1 << 63)))
    n = docs.count()
    count = min(MOST_BUCKETS, max(1, n // BUCKET_ROWS))
    shares = F.array(*(F.lit((k + 1) / count) for k in range(count)))
    bounds = docs.agg(F.sort_array(F.array_distinct(F.approx_percentile(place, shares, F.lit(max(10000, 4 * count))))), F.max(place)).first()
    splits = sorted({*(bounds[0] or []), *([] if bounds[1] is None else [bounds[1]])})
    known = F.lit(splits).cast("array<bigint>")
    steps = F.lit([1 << k for k in reversed(range(max(1, len(splits).bit_length())))]).cast("array<int>")

    def step(at: Column, by: Column) -> Column:
        return F.when((at + by <= len(splits)) & (F.get(known, at + by - 1) < F.col("_place")), at + by).otherwise(at)

    bucket = F.aggregate(steps, F.lit(0), step)
    placed = docs.withColumn("_place", place).withColumn("_bucket", bucket)
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest"))
    above = F.struct(((F.col("_bucket") + 1) % max(1, len(splits))).alias("bucket"), F.lit(True).alias("guest"))
    largest = F.get(known, F.col("_bucket")) == F.col("_place")
    seats = placed.withColumn("_seat", F.explode(F.when(largest, F.array(own, above)).otherwise(F.array(own))))
    seated = seats.withColumns({"_at": F.col("_seat.bucket"), "_guest": F.col("_seat.guest")}).repartition("_at")
    for name, column in (made or {}).items():
        seated = seated.withColumn(name, column())
    line = Window.partitionBy("_at").orderBy("_guest", F.desc("_place"), *order)
    led = seated.withColumn("next", F.lead(F.struct(*carry)).over(line))
    return led.where(~F.col("_guest")).drop("_place", "_bucket", "_seat", "_at", "_guest")


def compare_edited(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text, its edit with the next document's beginning, and how alike their fingerprints are."""
    whole = docs.select(F.col(id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Signatures compress badly: they are made after the move, once for a text and its neighbour.
    own = {"_words": lambda: words(F.col("text")), "sigs": lambda: signatures(F.col("_words"))}
    beside = beside_next(whole, "id", ["text"], ["text", "sigs"], own)
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - half), F.substr(F.col("next.text"), F.lit(1), half))
    joined = beside.select("id", "sigs", F.col("next.sigs").alias("next_sigs"), n.cast("bigint").alias("n_chars"), edited.alias("edited"))
    both = with_signatures(joined, "edited", "edited_sigs")
    return both.select(
        F.col("id").alias(id),
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("sigs")).alias("fingerprint"),
        fingerprint(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"),
        likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
        length_class(F.col("sigs"), SIMILARITY).alias("length_class"),
    )
