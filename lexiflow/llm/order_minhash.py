"""Order-sensitive fingerprints of texts, with DataFrame functions only.

A text's tokens are its runs between white space, cut into parts of at most PART
characters, so texts without spaces have many too. Its k-mers of tokens are numbered
by occurrence, hashed once and dealt to bins by the hash. Each bin has an order of its own over all k-mers: first those
dealt to it by their hash, then the others by a hash of that and the bin. The
least in that order are selected, put back into the order of the text and hashed
as a tuple, so that a bin agrees only where both the selected k-mers and their
order do. The likeness of two fingerprints is the share of the bins that agree.

Defined cases: a null text is the empty text; texts without words (no
character but white space) have one k-mer, the text itself, so equal texts have
equal fingerprints; texts of fewer than k tokens have one k-mer. Texts of any length
are cut in the same way; very long ones take time in proportion to n log n of their
tokens. Rows with equal ids follow one another in the order of a hash of their texts,
equal rows in any order; rows with a null id come first. A single
row's next row is itself. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.llm.common import let, text_of

#: Bits that hold a k-mer's place in its text (no array is longer), and that choose its bin.
PLACE_BITS, BIN_BITS = 31, 6
#: Most characters of a token.
PART = 8
#: Groups of neighbouring rows for each shuffle partition, and sampled rows for each group.
GROUPS, SAMPLED = 4, 10


def signature(text: Column, k: int = 2, picked: int = 2) -> Column:
    """array<bigint>, sorted: for each bin its number in the top bits and below them the
    hash of the bin's `picked` least k-mers in the order of the text."""
    place = F.lit((1 << PLACE_BITS) - 1).cast("bigint")
    hash_mask = F.lit((1 << (63 - PLACE_BITS)) - 1).cast("bigint")
    low = F.lit((1 << (63 - BIN_BITS)) - 1).cast("bigint")

    def packed(value: Column, at: Column) -> Column:
        return F.shiftleft(value.bitwiseAND(hash_mask), PLACE_BITS).bitwiseOR(at)

    def hashed(v: Column) -> Column:
        return F.shiftright(v, PLACE_BITS)

    def bin_of(v: Column) -> Column:
        return F.shiftright(v, 63 - BIN_BITS)

    def kmers(words: Column) -> Column:
        return F.transform(words, lambda w, i: packed(F.xxhash64(w, *(F.get(words, i + n) for n in range(1, k))), i.cast("bigint")))

    def run_length(s: Column, v: Column, i: Column) -> Column:
        """How many directly before i have its hash: by halving, as equal ones are together."""
        jumps = F.array(*(F.lit(1 << bit) for bit in reversed(range(PLACE_BITS))))
        return F.aggregate(jumps, F.lit(0), lambda n, jump: F.when((n + jump <= i) & (hashed(F.get(s, i - n - jump)) == hashed(v)), n + jump).otherwise(n))

    def occurrences(s: Column) -> Column:
        """Sorted k-mers, each hashed anew with the number of its occurrence."""
        again = lambda v, i: (i > 0) & (hashed(F.get(s, i - 1)) == hashed(v))
        return F.transform(s, lambda v, i: packed(F.xxhash64(hashed(v), F.when(again(v, i), run_length(s, v, i)).otherwise(F.lit(0))), v.bitwiseAND(place)))

    def least(s: Column) -> Column:
        """The first `picked` of each bin."""
        return F.filter(s, lambda v, i: (i < picked) | (bin_of(F.get(s, i - picked)) != bin_of(v)))

    def tuple_of(own: Column, number: Column) -> Column:
        """A bin's k-mers in the order of their places, as one hash."""
        ordered = F.array_sort(F.transform(own, lambda v: F.struct(v.bitwiseAND(place).alias("at"), hashed(v).alias("hash"))))
        return F.shiftleft(number, 63 - BIN_BITS).bitwiseOR(F.xxhash64(F.transform(ordered, lambda x: x["hash"])).bitwiseAND(low))

    def ranked(s: Column, number: Column) -> Column:
        """The `picked` least of all k-mers in the order of a bin that holds fewer."""
        other = lambda v: F.lit(1 << 62).bitwiseOR(packed(F.xxhash64(hashed(v), number).bitwiseAND(F.lit((1 << (62 - PLACE_BITS)) - 1)), v.bitwiseAND(place)))
        return F.slice(F.sort_array(F.transform(s, lambda v: F.when(bin_of(v) == number, v.bitwiseAND(low)).otherwise(other(v)))), 1, picked)

    def tuples(every: Column, s: Column) -> Column:
        """The bins in order: those with `picked` of their own, and those that need others."""
        full = F.filter(F.transform(s, lambda v, i: F.when((i >= picked - 1) & (bin_of(F.get(s, i - picked + 1)) == bin_of(v)), i)), lambda i: i.isNotNull())
        own = F.transform(full, lambda i: tuple_of(F.slice(s, i - picked + 2, picked), bin_of(F.get(s, i))))
        bins = F.sequence(F.lit(0).cast("bigint"), F.lit((1 << BIN_BITS) - 1).cast("bigint"))
        needy = F.array_except(bins, F.transform(full, lambda i: bin_of(F.get(s, i))))
        return F.sort_array(F.concat(own, F.transform(needy, lambda n: tuple_of(ranked(every, n), n))))

    def words_of(t: Column) -> Column:
        words = F.regexp_extract_all(t, F.lit(f"([^ \\t\\n\\r]{{1,{PART}}})"), F.lit(1))
        return let(words, lambda w: F.when(F.size(w) == 0, F.array(t)).when(F.size(w) < k, F.array(F.array_join(w, " "))).otherwise(F.slice(w, 1, F.size(w))))

    pairs = let(words_of(text), lambda w: F.sort_array(kmers(w)))
    return let(let(pairs, lambda s: F.sort_array(occurrences(s))), lambda every: let(least(every), lambda s: tuples(every, s)))


def likeness(a: Column, b: Column) -> Column:
    """The share of bins filled in either signature that agree in both."""
    bins = lambda s: F.transform(s, lambda v: F.shiftright(v, 63 - BIN_BITS))
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(bins(a), bins(b)))


def as_text(s: Column) -> Column:
    """A signature as a string of hexadecimal numbers."""
    return F.array_join(F.transform(s, lambda v: F.lower(F.hex(v))), ".")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 2, picked: int = 2) -> DataFrame:
    """(id, signature array<bigint>) of each whole text."""
    return df.select(F.col(id_col), signature(text_of(text_col), k, picked).alias("signature"))


def next_key() -> Column:
    """What rows (id, digest) are ordered by; rows without an id come first."""
    return F.struct(F.col("id").isNotNull().alias("known"), F.coalesce("id", F.lit(0)).cast("bigint").alias("i"), F.col("digest"))


def bounds_of(keys: DataFrame, most: int) -> Column:
    """The first keys of at most `most` groups of neighbours, about equal, in ascending order, as
    a subquery: the least key and some of about SAMPLED keys a group. Its size in the plan
    does not depend on `most`; what stands in one task is bounded by it."""
    share = min(1.0, SAMPLED * most / max(keys.count(), 1))
    sampled = keys.sample(share, seed=11).unionByName(keys.agg(F.min("key").alias("key"))).agg(F.array_sort(F.collect_list("key")).alias("s"))
    picked = F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda k: F.get("s", F.floor(F.size("s").cast("bigint") * k / most).cast("int")))
    return sampled.select(F.array_distinct(picked)).scalar()


def with_next(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Adds next_<column>: the value in the row that follows by id, for the last row the
    first's. Needs columns id and digest (of the text). Sampled bounds deal the rows to
    groups of neighbours, whatever the ids are like; each row goes to its group, and the
    first of a group to the one before too, so all meet in a single exchange. Every bound is
    the key of a row, the first of its group."""
    most = GROUPS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = bounds_of(rows.select(next_key().alias("key")), most)
    dealt = rows.withColumn("key", next_key()).withColumn("g", F.lit(0))
    for bit in reversed(range(most.bit_length())):  # the last bound that is not above the key, by halving
        further = F.col("g") + (1 << bit)
        dealt = dealt.withColumn("g", F.when(F.get(bounds, further) <= F.col("key"), further).otherwise(F.col("g")))
    own = F.struct(F.col("g").alias("to"), F.lit(False).alias("sent"))
    before = F.when(F.col("g") > 0, F.col("g") - 1).otherwise(F.size(bounds) - 1)
    both = F.when(F.get(bounds, F.col("g")) == F.col("key"), F.array(own, F.struct(before.alias("to"), F.lit(True).alias("sent")))).otherwise(F.array(own))
    dealt = dealt.select(*rows.columns, "key", F.explode(both).alias("d")).select(*rows.columns, "key", "d.*")
    in_group = Window.partitionBy("to").orderBy("sent", "key")
    return dealt.select(*rows.columns, "sent", *(F.lead(c).over(in_group).alias(f"next_{c}") for c in columns)).where("not sent").drop("sent")


def edit_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each text and its edited text (its last half replaced by as many characters
    from the start of the next text): both fingerprints, the digest of the edited
    text, and the likeness to it and to the next text."""
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text")).withColumn("signature", signature(F.col("text")))
    both = with_next(rows, ["text", "signature"])
    half = F.floor(F.length("text") / 2)
    edited = F.concat(F.expr("substring(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("substring(next_text, 1, cast(floor(length(text) / 2) as int))"))
    both = both.select("id", "signature", "next_signature", F.length("text").cast("bigint").alias("n_chars"), half, edited.alias("edited"))
    both = both.withColumn("edited_signature", signature(F.col("edited")))
    return both.select(
        F.col("id").alias(id_col),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("signature")).alias("fingerprint"),
        as_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"),
    )
