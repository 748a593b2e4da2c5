"""Document fingerprints by one-permutation MinHash, in DataFrame functions only.

Fingerprint. Every shingle of five words is hashed once; the leading bits of its hash name one of ``BINS`` bins, which
keeps its smallest hash. An empty bin takes the hash of a filled one: of all filled bins the one that comes first
in a random order that belongs to the empty bin alone, the same for every document (optimal densification). Of each bin
the ``BITS`` low bits are kept, packed as hexadecimal text.

Likeness. Two unequal hashes agree in their low bits with a probability of 2**-BITS, so with a share p of bins that agree
the similarity is (p - 2**-BITS) / (1 - 2**-BITS), at least 0. Its standard deviation is some sqrt(J (1 - J) / BINS).

Neighbours. ``compared`` holds a document against its next in descending order of doc_id. Documents are dealt into ranges of
doc_id, whose bounds are approximate quantiles; an id that many rows share, null ids too, has ranges of its own, over
which its rows are spread. The first document of each range is a guest at the end of the range before. So texts are
shuffled once, no task orders more than a range, and the driver gets the bounds only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialised

SHINGLE = 5
BINS = 128
BITS = 8
# Ranges per shuffle partition, so that partitions of several ranges even out.
RANGES = 4

_BIN_BITS = BINS.bit_length() - 1
_DIGITS = BITS // 4


def fingerprinted(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of its column ``text`` as ``name``; a null text counts as an empty one.

    Words are runs of letters and digits of the lower-cased text. A text of one to four words is one shingle, a
    text without words one shingle of itself. The empty text has the empty fingerprint.
    """
    own = [f"__{name}_{step}" for step in ("words", "hashes", "lowest", "filled", "bins")]
    words, hashes, lowest, filled, bins = (F.col(x) for x in own)
    plain = F.coalesce(F.col(text), F.lit(""))
    found = F.filter(F.split(F.lower(plain), r"[^\p{L}\p{N}]+"), lambda word: word != "")
    steps = [
        (own[0], F.when((F.size(found) == 0) & (plain != ""), F.array(plain)).otherwise(found)),
        (own[1], F.sort_array(_shingle_hashes(words))),
        (own[2], F.filter(hashes, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(hashes, i - 1))))),
        (own[3], F.transform(lowest, _bin)),
        (own[4], _densified(lowest, filled)),
        (name, F.array_join(F.transform(bins, _digits), "")),
    ]
    for step, value in steps:
        df = df.withColumn(step, value)
    return df.drop(*own)


def _shingle_hashes(words: Column) -> Column:
    """A hash per run of ``SHINGLE`` words; one of all words if they are fewer."""
    last = F.greatest(F.size(words) - SHINGLE, F.lit(0))
    starts = F.when(F.size(words) > 0, F.sequence(F.lit(1), last + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE))))


def _bin(x: Column) -> Column:
    """The bin of a hash, -BINS/2 to BINS/2 - 1, in the order of the hashes."""
    return F.shiftright(x, 64 - _BIN_BITS)


def _densified(lowest: Column, filled: Column) -> Column:
    """Per bin a number that ends in its bits, from the ``lowest`` hashes of the ``filled`` bins; empty if there is none."""
    every = F.sequence(F.lit(-BINS // 2), F.lit(BINS // 2 - 1))

    low = (1 << BITS) - 1

    def bits_of(place: Column) -> Column:
        # The order of the filled bins for this one, with the bits that are wanted in place of its lowest.
        def rank(x: Column) -> Column:
            return F.xxhash64(place, _bin(x)).bitwiseAND(F.lit(~low)).bitwiseOR(x.bitwiseAND(F.lit(low)))

        own = F.array_position(filled, place.cast("long"))
        return F.when(own > 0, F.get(lowest, (own - 1).cast("int"))).otherwise(F.array_min(F.transform(lowest, rank)))

    return F.when(F.size(lowest) > 0, F.transform(every, bits_of)).otherwise(F.array().cast("array<bigint>"))


def _digits(x: Column) -> Column:
    return F.lower(F.lpad(F.hex(x.bitwiseAND(F.lit((1 << BITS) - 1))), _DIGITS, "0"))


def likeness(a: Column, b: Column) -> Column:
    """The estimated similarity of two fingerprints, 0 to 1; 1 for two empty ones and 0 for one."""
    places = F.sequence(F.lit(0), F.lit(BINS - 1))

    def digits(fingerprint: Column, i: Column) -> Column:
        return F.substring(fingerprint, i * _DIGITS + 1, F.lit(_DIGITS))

    agreeing = F.size(F.filter(places, lambda i: digits(a, i) == digits(b, i)))
    chance = 2.0**-BITS
    corrected = F.greatest((agreeing / BINS - chance) / (1 - chance), F.lit(0.0))
    return F.when(a == b, 1.0).when((a == "") | (b == ""), 0.0).otherwise(corrected)


def compared(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row of ``docs``.

    In the edited text the last third of the code points, rounded down, is replaced by as many first ones of the next
    document's text, or all if it has fewer. Next is the document of the next lower doc_id, after the last the first. Null
    ids come last; rows of one id follow each other by the digest of their text, equal rows directly. A single row
    is its own next. Null texts count as empty ones; no rows give none; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    placed, heads, copied = _ranges(rows)
    placed = placed.withColumn("__copies", F.lit(1).cast("long"))
    if copied:
        # Rows of one id and text that are many go as one row with their number.
        many = F.broadcast(docs.sparkSession.createDataFrame(copied, "__id long, __tie string, __n long"))
        key = ["__id", "__tie"]
        once = placed.join(many, key).groupBy(*key).agg(
            *[F.first(c).alias(c) for c in ("doc_id", "text", "__range")], F.first("__n").alias("__copies")
        )
        placed = placed.join(many, key, "left_anti").unionByName(once)
    marked = placed.join(F.broadcast(heads), ["__id", "__tie", "__range"], "left")
    own = F.struct(F.col("__range").alias("range"), F.lit(0).alias("guest"))
    guest = F.struct(F.col("__before").alias("range"), F.lit(1).alias("guest"))
    seats = F.when(F.col("__before").isNull(), F.array(own)).otherwise(F.array(own, guest))
    seated = fingerprinted(marked, "text", "fingerprint").withColumn("seat", F.explode(seats))
    seated = seated.withColumns({"__seat": F.col("seat.range"), "__guest": F.col("seat.guest")})
    order = W.partitionBy("__seat").orderBy("__guest", F.col("doc_id").desc_nulls_last(), F.col("__tie").desc())
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    kept = seated.select("doc_id", "text", "fingerprint", "__copies", "__tie", "__seat", "__guest")
    leads = {"__next_text": F.lead("text").over(order), "__next": F.lead("fingerprint").over(order)}
    following = kept.withColumns(leads).where("__guest = 0")
    if copied:
        # All copies but the last are followed by one of themselves.
        is_last = F.col("__copy") == 1
        following = following.withColumn("__copy", F.explode(F.sequence(F.lit(1), "__copies"))).withColumns(
            {
                "__next_text": F.when(is_last, F.col("__next_text")).otherwise(F.col("text")),
                "__next": F.when(is_last, F.col("__next")).otherwise(F.col("fingerprint")),
            }
        )
    start = F.substring("text", F.lit(1), n - third)
    following = following.withColumn("__edited", F.concat(start, F.substring("__next_text", F.lit(1), third)))
    return fingerprinted(following, "__edited", "edited_fingerprint").select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        F.sha2(F.encode("__edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("__next")).alias("near_next"),
    )


def _ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame, list[tuple]]:
    """The rows with their range, numbered in descending order of doc_id; the first row of each range; copied rows.

    A bound of many rows is the approximate quantile of several shares; it gets as many ranges of its own, over which
    its rows are spread by their text. Rows that agree in id and text beyond an even share of all rows are ``copied``:
    (id, digest, number) of each, fewer than there are ranges. What tells rows apart is their content, so reading
    ``docs`` twice, or once more after a loss, gives the same places in whatever order its rows come.
    """
    parts = RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / parts for k in range(1, parts)]
    found = docs.agg(
        F.percentile_approx("doc_id", F.lit(shares), F.lit(max(10_000, 10 * parts))),
        F.count("doc_id"),
        F.count("*"),
    ).first()
    bounds, known, rows = found[0] or [], found[1], found[2]
    shared = {b: bounds.count(b) for b in set(bounds) if bounds.count(b) > 1}
    cuts = sorted(set(bounds) | {b - 1 for b in shared})
    # Ranges in descending order: above the last cut, from cut to cut, then the rows without an id.
    unnamed = max(1, math.ceil((rows - known) / max(1, rows) * parts))
    widths = [1, *[shared.get(cut, 1) for cut in reversed(cuts)], unnamed]
    starts = [sum(widths[:k]) for k in range(len(widths))]
    last = F.lit(len(widths) - 1)
    place = F.when(F.col("doc_id").isNull(), last).otherwise(F.lit(len(cuts)) - _above(F.col("doc_id"), cuts))
    part = F.floor(F.conv(F.substring("__tie", 1, 8), 16, 10).cast("long") * F.get(F.lit(widths), F.col("__place")) / 2**32)
    placed = (
        docs.withColumn("__tie", F.sha2(F.encode("text", "UTF-8"), 256))
        .withColumn("__place", place)
        .withColumn("__range", F.get(F.lit(starts), F.col("__place")) + F.get(F.lit(widths), F.col("__place")) - 1 - part)
        .withColumn("__id", F.coalesce("doc_id", F.lit(-(2**63))))
        .drop("__place")
    )
    key = F.struct("__id", "__tie")
    counted = placed.groupBy("__range", "__id", "__tie").agg(F.count("*").alias("__n"))
    many = F.when(F.col("__n") > max(1, rows // parts), F.struct("__id", "__tie", "__n"))
    least = materialised(
        counted.groupBy("__range").agg(F.max(key).alias("head"), F.collect_list(many).alias("copied")), "fingerprint-ranges"
    )
    # One row per range that has rows; the first range comes after the last.
    in_order = W.orderBy("__range")
    every = in_order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = F.coalesce(F.lag("__range").over(in_order), F.last("__range").over(every))
    heads = least.select("head.*", "__range", before.alias("__before"))
    copied = least.select(F.inline("copied")).collect()
    return placed, heads, [tuple(x) for x in copied]


def _above(value: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are below ``value``, by binary search."""
    if not cuts:
        return F.lit(0)
    steps = [1 << k for k in reversed(range(len(cuts).bit_length()))]
    table = F.lit(cuts).cast("array<bigint>")

    def further(place: Column, step: Column) -> Column:
        cut = F.get(table, place + step - 1)
        return F.when((place + step <= len(cuts)) & (cut < value), place + step).otherwise(place)

    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), further)
