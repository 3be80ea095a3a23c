"""Order MinHash: fingerprints that are sensitive to edit distance, in SQL functions only.

A text is cut into short pieces of its words, and every run of ``PIECES`` pieces is a
k-mer. Equal k-mers are numbered in text order, so each occurrence counts. The hash of
(k-mer, occurrence) decides its bin and its order there; every bin selects its
``TUPLE`` smallest, puts them back into text order, and hashes that tuple. The tuple changes when
k-mers change and when they change places, which a plain MinHash would not notice.
One hash serves all bins, so the work is that of sorting the k-mers once.

Defined cases: null counts as empty; a text without a visible character has an empty fingerprint
(all bins zero), and two such are wholly alike (1). A text with fewer pieces than a k-mer is one k-mer.
Bins that neither of two texts fills don't count in their likeness. Repeated rows have
the same fingerprint. Input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.frames import text_of, with_outputs

#: Up to three visible characters of a word: short enough to see edits inside
#: words and in scripts without spaces, long enough for few pieces.
PIECE = r"\S{1,3}"
PIECES = 3
BINS = 64
TUPLE = 2
#: Low bits of a packed number that hold the place in the text.
PLACE_BITS = 27
_PLACES = (1 << PLACE_BITS) - 1
_BIN_SHIFT = 64 - (BINS - 1).bit_length()


def _bind(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def _packed(hashed: Column, place: Column) -> Column:
    """A hash in the high bits, the place in the text in the low ones."""
    return hashed.bitwiseAND(~_PLACES).bitwiseOR(place.cast("bigint").bitwiseAND(_PLACES))


def _kmer(packed: Column) -> Column:
    return F.shiftright(packed, PLACE_BITS)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, _BIN_SHIFT)


def _kmers(pieces: Column) -> Column:
    """Hash and place of each k-mer, in text order."""
    count = F.greatest(F.size(pieces) - (PIECES - 1), F.least(F.size(pieces), F.lit(1)))
    return F.transform(
        F.slice(pieces, 1, count),
        lambda piece, i: _packed(F.xxhash64(piece, *[F.get(pieces, i + n) for n in range(1, PIECES)]), i),
    )


def _repeats(ordered: Column) -> Column:
    """Later occurrences of k-mers, with the hash of (k-mer, occurrence number).

    In the ordered array equal k-mers are neighbours in text order. A repeat equals the one before it, so
    repeats of one k-mer are consecutive places and the first of them has number 1.
    """
    empty = F.array().cast("array<bigint>")

    def number(places: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(places) - 1),
            lambda j: (j == 0) | (F.get(places, j) != F.get(places, j - 1) + 1),
        )
        return _bind(
            starts,
            lambda firsts: F.flatten(
                F.transform(
                    firsts,
                    lambda j, n: F.transform(
                        F.sequence(j, F.coalesce(F.get(firsts, n + 1), F.size(places)) - 1),
                        lambda t: _bind(
                            F.get(ordered, F.get(places, t)), lambda x: _packed(F.xxhash64(_kmer(x), t - j + 1), x)
                        ),
                    ),
                )
            ),
        )

    places = F.filter(
        F.when(F.size(ordered) > 1, F.sequence(F.lit(1), F.size(ordered) - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: _kmer(F.get(ordered, i)) == _kmer(F.get(ordered, i - 1)),
    )
    return _bind(places, lambda p: F.when(F.size(p) == 0, empty).otherwise(number(p)))


def _firsts(ordered: Column) -> Column:
    """First occurrences; their hash is that of the k-mer itself."""
    return F.filter(ordered, lambda x, i: (i == 0) | (_kmer(x) != _kmer(F.get(ordered, F.greatest(i - 1, F.lit(0))))))


def _smallest(ordered: Column) -> Column:
    """The first ``TUPLE`` of each bin of an ordered array."""
    return F.filter(ordered, lambda x, i: (i < TUPLE) | (_bin(x) != _bin(F.get(ordered, F.greatest(i - TUPLE, F.lit(0))))))


def _tuples(chosen: Column) -> Column:
    """The hash of each bin's tuple in text order; 0 for an empty bin."""
    # The largest number of every bin marks its end, so that no bin is missing.
    ends = F.transform(
        F.sequence(F.lit(-(BINS // 2)).cast("bigint"), F.lit(BINS // 2 - 1).cast("bigint")),
        lambda b: F.shiftleft(b, _BIN_SHIFT).bitwiseOR((1 << _BIN_SHIFT) - 1),
    )

    def of_bin(items: Column, i: Column) -> Column:
        own = F.filter(
            F.slice(items, i + 1, TUPLE),
            lambda x: (_bin(x) == _bin(F.get(items, i))) & (x.bitwiseAND((1 << _BIN_SHIFT) - 1) != (1 << _BIN_SHIFT) - 1),
        )
        in_text = F.array_sort(F.transform(own, lambda x: F.struct(x.bitwiseAND(_PLACES).alias("place"), _kmer(x).alias("kmer"))))
        return _bind(
            in_text,
            lambda t: F.when(F.size(t) == 0, F.lit(0).cast("bigint")).otherwise(
                F.greatest(F.xxhash64(t["kmer"]).bitwiseAND(0xFFFFFFFF), F.lit(1).cast("bigint"))
            ),
        )

    def all_bins(items: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(items) - 1),
            lambda i: (i == 0) | (_bin(F.get(items, i)) != _bin(F.get(items, F.greatest(i - 1, F.lit(0))))),
        )
        return F.transform(starts, lambda i: of_bin(items, i))

    ordered = F.sort_array(F.concat(chosen, ends))
    return _bind(_bind(ordered, _smallest), all_bins)


def fingerprint(df: DataFrame, text: Column, output: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of a text: an array of ``BINS`` numbers below 2^32."""
    steps = {
        "_pieces": lambda c: F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PIECE), F.lit(0)),
        "_kmers": lambda c: _kmers(c["_pieces"]),
        # Sorting numbers runs as compiled code when it stands alone.
        "_ordered": lambda c: F.sort_array(c["_kmers"]),
        "_later": lambda c: _repeats(c["_ordered"]),
        "_later_ordered": lambda c: F.sort_array(c["_later"]),
        "_chosen": lambda c: F.concat(_bind(_firsts(c["_ordered"]), _smallest), _smallest(c["_later_ordered"])),
        output: lambda c: _tuples(c["_chosen"]),
    }
    used = {"_kmers": ["_pieces"], "_ordered": ["_kmers"], "_later_ordered": ["_later"], output: ["_chosen"], "_chosen": ["_ordered", "_later_ordered"]}
    for name, step in steps.items():
        df = df.withColumn(name, step({n: F.col(n) for n in df.columns if n.startswith("_")})).drop(*used.get(name, []))
    return df


def likeness(one: Column, other: Column) -> Column:
    """Share of the bins that either fills in which both have the same tuple; 1 if neither fills any."""
    same = F.size(F.filter(F.arrays_zip(one.alias("a"), other.alias("b")), lambda p: (p["a"] == p["b"]) & (p["a"] != 0)))
    filled = F.size(F.filter(F.arrays_zip(one.alias("a"), other.alias("b")), lambda p: (p["a"] != 0) | (p["b"] != 0)))
    return F.when(filled == 0, 1.0).otherwise(same / filled)


def hex_digits(value: Column) -> Column:
    """The fingerprint as text, eight hex digits a bin."""
    return F.concat_ws("", F.transform(value, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")))


def add_fingerprint(df: DataFrame, text: str = "text", output: str = "fingerprint") -> DataFrame:
    """Add the fingerprint of every text as hex digits."""
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), text_of(text).alias("text"))
    done = fingerprint(held, F.col("text"), "_fingerprint")
    return with_outputs(
        done.select("row.*", F.col("_fingerprint").alias("__fp")), {output: hex_digits(F.col("__fp"))}
    ).drop("__fp")


def with_next(df: DataFrame, key: str, columns: list[str], blocks: int) -> DataFrame:
    """Add ``next_<column>`` of the row with the next lower key; after the last row comes the first.

    Rows go to blocks of neighbouring keys, so each block is sorted by itself. The
    highest key of a block is known from the boundaries; its rows are sent to the
    block above as well, whose last row they follow. Null keys count as the lowest;
    rows of equal key follow each other by falling text of their columns.
    """
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(-(2**63)))
    shares = [n / blocks for n in range(1, blocks)]
    keys = df.select(order.alias("key"))
    found = keys.agg(F.percentile_approx("key", shares, 10 * blocks).alias("cuts"), F.max("key").alias("top")).first()
    cuts = sorted(set(found["cuts"] or []))
    bounds = F.array(*[F.lit(c).cast("bigint") for c in cuts])
    # Binary search: the number of cuts below the key.
    steps = max(1, len(cuts).bit_length())
    low_high = F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = (s["low"] < s["high"]) & (F.get(bounds, middle) < F.col("_key"))
        return F.struct(
            F.when(below, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(below | (s["low"] >= s["high"]), s["high"]).otherwise(middle).alias("high"),
        )

    block = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), low_high, halve, lambda s: s["low"])
    placed = df.withColumn("_key", order).withColumn("_own", block)
    targets = F.array(F.struct(F.col("_own").alias("block"), F.lit(0).alias("copy")))
    if cuts:
        is_cut = F.get(bounds, F.col("_own")) == F.col("_key")
        above = F.array(F.struct((F.col("_own") + 1).alias("block"), F.lit(1).alias("copy")))
        targets = F.concat(targets, F.when(is_cut, above).otherwise(F.slice(above, 1, 0)))
    around = F.array(F.struct(F.lit(0).alias("block"), F.lit(2).alias("copy")))
    targets = F.concat(targets, F.when(F.col("_key") == F.lit(found["top"]), around).otherwise(F.slice(around, 1, 0)))
    sent = placed.withColumn("_to", F.explode(targets)).select(*df.columns, "_key", "_to.block", "_to.copy")
    falling = Window.partitionBy("block").orderBy("copy", F.col("_key").desc(), *[F.col(c).desc() for c in columns])
    ahead = sent.select("*", *[F.lead(c).over(falling).alias(f"next_{c}") for c in columns])
    return ahead.filter("copy = 0").drop("_key", "block", "copy")
