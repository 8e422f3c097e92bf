"""Line deduplication by an exact set-similarity join (operator 6), DataFrame functions only.

A line is the set of its lower-case words.  Words are put in order by rarity, and
two sets with a Jaccard similarity of at least t share a word among their first
n - ceil(t n) + 1, so only these prefixes are joined.  Length, positional and parity
filters (the bits in which the words' parity maps differ are at most the words in
which the sets differ) drop nearly all other pairs within the join, and the rest are
verified on the hashes of all their words.  Rarity comes from a table of word counts by hash bucket over all
lines, of fixed size; any order gives the same pairs, a better one fewer candidates.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harrow.llm.store import Store

SKETCH_BITS = 15
MAPS = ("p0", "p1")
#: Pairs of sets, and settled sets, up to which their ids are broadcast (48 and 16 bytes each); beyond that the sides are shuffled.
BROADCAST_PAIRS, BROADCAST_SETS = 250_000, 500_000
#: Sets that share a key up to which they are left to the join of all prefix words, as that meets at most so many near copies of each.
CROWD = 32


def _split(line: Column) -> Column:
    """The lower-case words of a line between ASCII white space, with empty ones where it is repeated."""
    uneven = reduce(Column.__or__, [F.contains(line, F.lit(c)) for c in "\t\r\x0b\x0c"])
    plain = F.when(uneven, F.translate(line, "\t\r\x0b\x0c", "    ")).otherwise(line)
    return F.split(F.lower(plain), " ")


def line_words(line: Column) -> Column:
    """The distinct lower-case words of a line."""
    return F.array_remove(F.array_distinct(_split(line)), "")


def rarity_classes(docs: DataFrame) -> Column:
    """For each hash bucket of words, how often its words occur in all texts, as they are written between
    spaces, in steps of half a power of two, as one constant array of bigints; small ones, as every plan on the driver spells them out."""
    words = docs.select(F.explode(F.split("text", " ")).alias("w"))
    bucket = F.xxhash64("w").bitwiseAND(F.lit((1 << SKETCH_BITS) - 1))
    counts = words.groupBy(bucket.cast("int").alias("b")).agg(F.count("*").alias("n")).collect()
    classes = [0] * (1 << SKETCH_BITS)
    for r in counts:
        classes[r["b"]] = (r["n"] ** 2).bit_length()
    return F.split(F.lit(",".join(map(str, classes))), ",").cast("array<bigint>")


def _hashes(line: Column) -> Column:
    """The distinct hashes of a line's words in order."""
    return F.sort_array(F.array_remove(F.array_distinct(F.transform(_split(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit(""))))


def _keys(hashes: Column, classes: Column) -> Column:
    """A line's words as bigints in order of rarity: count class, then hash."""
    zero = F.lit(0).cast("long")
    class_of = lambda h: F.get(classes, h.bitwiseAND(F.lit((1 << SKETCH_BITS) - 1)))
    # never null, so that the array is sorted as plain numbers
    return F.sort_array(F.transform(hashes, lambda h: F.coalesce(F.shiftleft(class_of(h), 56), zero).bitwiseOR(F.shiftrightunsigned(h, 8))))


def _parity(keys: Column, half: bool = False) -> Column:
    """64 bits, each telling whether an odd number of the words, or of about half of them, fall on it; the half is told by a bit of its own."""
    bits = [0] * 64 * half + [1 << b for b in range(63)] + [-(1 << 63)]
    # looked up, as each step of a lambda costs about as much as the whole of a compiled expression
    table = F.array(*(F.lit(b).cast("long") for b in bits))
    return F.aggregate(keys, F.lit(0).cast("long"), lambda a, k: a.bitwiseXOR(F.get(table, k.bitwiseAND(F.lit(len(bits) - 1)))))


def _needed(nx: Column, ny: Column, threshold: float) -> Column:
    """Common words that sets of these sizes need."""
    return F.lit(threshold / (1 + threshold)) * (nx + ny) - F.lit(1e-9)


def line_classes(docs: DataFrame, store: Store, threshold: float) -> DataFrame:
    """One row for each set of words: its digest ``id, d2``, the first line's place ``doc_id, pos, h``,
    its size ``n``, its parity maps ``p0, p1``, its ``low`` and ``high`` min-hashes of two words and its rarest words, the ``prefix``."""
    classes = rarity_classes(docs)
    lines = docs.select("doc_id", "h", F.posexplode(F.split("text", "\n")).alias("pos", "line")).where(F.btrim("line", F.lit(" \t\r\x0b\f")) != "")
    hashed = lines.select("doc_id", "pos", "h", _hashes(F.col("line")).alias("hashes"))
    n = F.size("hashes")
    low, high = F.xxhash64(F.lit(1), F.slice("hashes", 1, 2)), F.xxhash64(F.lit(2), F.slice("hashes", F.greatest(n - 1, F.lit(1)), 2))
    sets = hashed.select("doc_id", "pos", "h", n.alias("n"), low.alias("low"), high.alias("high"), _keys(F.col("hashes"), classes).alias("keys"))
    n = F.col("n")
    prefix = F.slice("keys", 1, (n - F.ceil(n * F.lit(threshold) - F.lit(1e-9)) + 1).cast("int"))
    rows = sets.select(
        F.xxhash64("keys").alias("id"), F.xxhash64(F.lit(1), F.col("keys")).alias("d2"),
        F.struct("doc_id", "pos", "h", "n", _parity(F.col("keys")).alias("p0"), _parity(F.col("keys"), half=True).alias("p1"), "low", "high", prefix.alias("prefix")).alias("line"),
    )
    return store.save(rows.groupBy("id", "d2").agg(F.min("line").alias("line")).select("id", "d2", "line.*"), "classes")


#: Bits for a line's place, its number of words and a word's place in the prefix; larger values are held at the top.
_POS, _N, _I = 30, 20, 13


def prefix_entries(classes: DataFrame, open_sets: Column, keys: Column | str = "prefix") -> DataFrame:
    """One row for each prefix word, or other key: ``key, id, doc_id, packed`` and the parity maps; ``packed`` tells whether the set still looks for a partner."""
    most = lambda c, bits: F.least(c.cast("long"), F.lit((1 << bits) - 1))
    rows = classes.select("id", "doc_id", "pos", "n", *MAPS, open_sets.alias("open"), F.posexplode(keys).alias("i", "key"))
    packed = F.shiftleft(most(F.col("pos"), _POS), _N + _I).bitwiseOR(F.shiftleft(most(F.col("n"), _N), _I)).bitwiseOR(most(F.col("i"), _I))
    packed = F.when(F.col("open"), packed).otherwise(packed.bitwiseOR(F.lit(-(1 << 63))))
    return rows.select("key", "id", "doc_id", packed.alias("packed"), *MAPS)


def _part(packed: Column, shift: int, bits: int) -> Column:
    return F.shiftrightunsigned(packed, shift).bitwiseAND(F.lit((1 << bits) - 1))


def _size(packed: Column) -> Column:
    return _part(packed, _I, _N)


def _later(x, y) -> Column:
    """Whether the first line of entry ``x`` stands behind that of ``y``; both are functions from a field's name to its column."""
    px, py = (_part(e("packed"), _N + _I, _POS) for e in (x, y))
    return (x("doc_id") > y("doc_id")) | ((x("doc_id") == y("doc_id")) & ((px > py) | ((px == py) & (x("id") > y("id")))))


def _near(x, y, threshold: float) -> Column:
    """Whether the sets of two entries of one word may reach the threshold, by their sizes, the word's places and the parity maps."""
    nx, ny = _size(x("packed")), _size(y("packed"))
    ix, iy = (_part(e("packed"), 0, _I) for e in (x, y))
    need = _needed(nx, ny, threshold)
    # at the first common word, which one of a pair's rows has, all other common words stand behind it
    may = F.least(nx - ix, ny - iy)
    # words in which the sets differ, at least, among one half and among the others
    all_, half = (x(m).bitwiseXOR(y(m)) for m in MAPS)
    differ = F.bit_count(half) + F.bit_count(all_.bitwiseXOR(half))
    held = (F.greatest(nx, ny) == (1 << _N) - 1) | (F.greatest(ix, iy) == (1 << _I) - 1)
    # sizes come first, as they rule out most pairs at the least cost; a size held at the top only makes the need smaller
    return (F.least(nx, ny) >= need) & (held | ((differ <= nx + ny - 2 * need) & (may >= need)))


def _first_keys() -> Column:
    """The two min-hashes of a set and its rarest word."""
    return F.array("low", "high", F.get("prefix", F.lit(0)))


def crowded_keys(classes: DataFrame, store: Store, crowd: int) -> DataFrame:
    """The keys of :func:`first_pairs` that more than ``crowd`` sets have."""
    keys = classes.select(F.explode(_first_keys()).alias("key"))
    return store.save(keys.groupBy("key").count().where(F.col("count") > crowd).select("key"), "crowded")


def first_pairs(classes: DataFrame, crowded: DataFrame, threshold: float, shares: int = 4) -> DataFrame:
    """Each set with the earliest ones, one of each share, that have its rarest word or one of its min-hashes, where the key is crowded and they may match: linear in the entries.

    A near copy often has rare words of its own, so its rarest one isn't enough; a min-hash of two words is shared at a similarity of t with probability t squared.
    """
    keys = _first_keys()
    share = F.pmod(F.col("id"), F.lit(shares)).alias("share")
    few = F.broadcast(crowded) if crowded.count() <= BROADCAST_SETS else crowded
    entries = prefix_entries(classes, F.lit(True), keys).join(few, "key", "left_semi")
    some = entries.withColumn("packed", F.col("packed").bitwiseAND(F.lit(-(1 << _I)))).repartition("key")
    place = F.struct("doc_id", _part(F.col("packed"), _N + _I, _POS).alias("pos"), "id", "packed", *MAPS)
    earliest = some.groupBy("key", share).agg(F.min(place).alias("y")).select(F.col("key").alias("y_key"), "y.*")
    x, y = ((lambda f, e=e: F.col(f"{e}.{f}")) for e in "xy")
    joined = some.alias("x").join(earliest.alias("y"), (x("key") == y("y_key")) & _near(x, y, threshold) & _later(x, y))
    return joined.select(x("id").alias("later"), y("id").alias("earlier")).distinct()


def open_pairs(classes: DataFrame, threshold: float) -> DataFrame:
    """All pairs of a set that is still ``open`` and an earlier one that share a prefix word and may match.

    The smaller set of a pair is looked up by its index prefix of n - ceil(2 t n / (1 + t)) + 1 words, which is enough as the other has as many words or more.
    """
    # no key is null, which said here need not be asked of one side alone
    entries = prefix_entries(classes, F.col("open")).where(F.col("key").isNotNull()).repartition("key")
    n, i = _size(F.col("packed")), _part(F.col("packed"), 0, _I)
    held = (n == (1 << _N) - 1) | (i == (1 << _I) - 1)
    within = (i < n - F.ceil(n * F.lit(2 * threshold / (1 + threshold)) - F.lit(1e-9)) + 1) | held
    # entries are shuffled once for both sides: Spark would filter before the shuffle, and so shuffle the index again, but for the number of the partition, which is never negative
    index = entries.where(F.when(F.spark_partition_id() >= 0, within))
    x, y = ((lambda f, e=e: F.col(f"{e}.{f}")) for e in "xy")
    nx, ny = _size(x("packed")), _size(y("packed"))
    itself = (x("id") == y("id")) & (x("doc_id") == y("doc_id")) & (_part(x("packed"), _N + _I, _POS) == _part(y("packed"), _N + _I, _POS))
    larger = (nx > ny) | ((nx == ny) & (x("id") >= y("id")) & ~itself)
    later = _later(x, y)
    # rows that repeat an id may have lines at one place; which of two such lines is the later one, verified() tells
    same_place = (x("doc_id") == y("doc_id")) & (_part(x("packed"), _N + _I, _POS) == _part(y("packed"), _N + _I, _POS))
    looks = (F.when(later, x("packed")).otherwise(y("packed")) >= 0) | (same_place & ((x("packed") >= 0) | (y("packed") >= 0)))
    joined = entries.alias("x").join(index.alias("y"), (x("key") == y("key")) & larger & _near(x, y, threshold) & looks)
    return joined.select(F.when(later, x("id")).otherwise(y("id")).alias("later"), F.when(later, y("id")).otherwise(x("id")).alias("earlier")).distinct()


def verified(pairs: DataFrame, docs: DataFrame, places: DataFrame, store: Store, threshold: float) -> DataFrame:
    """The sets ``id, d2`` that stand behind the other one of a pair whose Jaccard similarity is at least the threshold.

    ``later`` and ``earlier`` only name the two sets of a pair: which stands behind is decided by the places, hashes of the texts included.

    The lines are read from their documents and compared by 64-bit hashes of their words; two words of one pair share
    one with a chance of 1 in 10^13 at most.  Sets that share an ``id`` are told apart by ``d2`` and their places.
    """
    small = (lambda df: F.broadcast(df)) if pairs.count() <= BROADCAST_PAIRS else (lambda df: df)
    ids = pairs.select(F.col("later").alias("id")).unionByName(pairs.select(F.col("earlier").alias("id"))).distinct()
    wanted = places.join(small(ids), "id", "left_semi").groupBy("doc_id", "h").agg(F.collect_list(F.struct("pos", "id", "d2")).alias("wanted"))
    read = docs.join(small(wanted), ["doc_id", "h"]).select("doc_id", "h", "wanted", F.split("text", "\n").alias("lines"))
    found = F.inline(F.transform("wanted", lambda x: F.struct(x["id"].alias("id"), x["d2"].alias("d2"), x["pos"].alias("pos"), F.get("lines", x["pos"]).alias("line"))))
    hashes = F.array_remove(F.array_distinct(F.transform(_split(F.col("line")), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))
    place = F.struct("doc_id", "pos", "h", "d2")
    words = store.save(read.select("doc_id", "h", found).select("id", "d2", place.alias("place"), hashes.alias("words")).dropDuplicates(["id", "d2"]), "words")
    side = lambda name: words.select(F.col("id").alias(name), F.col("d2").alias(f"{name}_d2"), F.col("words").alias(f"{name}_words"), F.col("place").alias(f"{name}_place"))
    both = F.size(F.array_intersect("later_words", "earlier_words"))
    enough = both >= _needed(F.size("later_words"), F.size("earlier_words"), threshold)
    joined = pairs.join(side("later"), "later").join(side("earlier"), "earlier").where((F.col("later_place") != F.col("earlier_place")) & enough)
    behind = lambda c: F.when(F.col("later_place") > F.col("earlier_place"), F.col(f"later{c}")).otherwise(F.col(f"earlier{c}"))
    found = store.save(joined.select(behind("").alias("id"), behind("_d2").alias("d2")).distinct(), "verified")
    store.drop(words)
    return found


def later_matches(docs: DataFrame, classes: DataFrame, store: Store, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The places of all sets, ``id, d2, doc_id, h, pos``, and the sets ``id, d2`` whose first line matches an earlier line.

    Where many sets share a key, each is compared first with the earliest of them, which settles most near copies of one line without
    comparing them all with all; only the sets that are still open are then joined with all earlier ones.
    """
    places = classes.select("id", "d2", "doc_id", "h", "pos")
    first = store.save(first_pairs(classes, crowded_keys(classes, store, CROWD), threshold), "first")
    store.release()
    settled = verified(first, docs, places, store, threshold)
    store.drop(first)
    done = settled.withColumn("done", F.lit(True))
    done = F.broadcast(done) if settled.count() <= BROADCAST_SETS else done
    marked = classes.drop("h").join(done, ["id", "d2"], "left").withColumn("open", F.col("done").isNull())
    store.release()
    pairs = store.save(open_pairs(marked, threshold), "pairs")
    store.release()
    rest = verified(pairs, docs, places, store, threshold)
    store.drop(pairs)
    return places, settled.unionByName(rest)


def dedup_lines(docs: DataFrame, store: Store, threshold: float = 0.8) -> DataFrame:
    """Remove every line that matches an earlier one, by ``doc_id`` and then place in the text.

    Returns the rows of ``docs(doc_id, text, ...)`` with ``text`` rewritten and ``n_lines, n_removed``
    added; columns of these names are replaced.  A line goes if an earlier line has the same words or a Jaccard
    similarity of at least ``threshold`` with it, whether or not that line stays.
    Lines without a word always stay.  Null texts stay null and match nothing, rows with a null id stay as
    they are.  Rows that repeat an id are ordered by their lines' places, then by hashes; rows that repeat id and
    text are one document, and each stays as that one does.  An empty table gives no rows.
    """
    docs = docs.drop("n_lines", "n_removed")
    hashed = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("h"), "text")
    classes = line_classes(hashed, store, threshold)
    store.release()
    places, later = later_matches(hashed, classes, store, threshold)
    kept = places.join(later, ["id", "d2"], "left_anti").groupBy(F.col("doc_id").alias("__of"), F.col("h").alias("__hash")).agg(F.collect_list("pos").alias("__kept"))
    joined = docs.join(kept, (F.col("doc_id") == F.col("__of")) & (F.xxhash64("text") == F.col("__hash")), "left")
    lines = F.split("text", "\n")
    blank = F.filter(F.sequence(F.lit(0), F.size("__lines") - 1), lambda i: ~F.rlike(F.get("__lines", i), F.lit(r"[^ \t\r\x0b\f]")))
    stay = F.sort_array(F.concat(blank, F.coalesce("__kept", F.array().cast("array<int>"))))
    whole = F.col("doc_id").isNull() | F.col("text").isNull() | (F.size("__kept") == F.size("__lines"))
    left = F.when(whole, F.col("__lines")).otherwise(F.transform(stay, lambda i: F.get("__lines", i)))
    return (
        joined.withColumn("__lines", lines)
        .withColumn("__left", left)
        .withColumn("text", F.when(F.size("__left") == F.size("__lines"), F.col("text")).otherwise(F.array_join("__left", "\n")))
        .withColumn("n_lines", F.coalesce(F.size("__lines"), F.lit(0)))
        .withColumn("n_removed", F.coalesce(F.size("__lines") - F.size("__left"), F.lit(0)))
        .select(*docs.columns, "n_lines", "n_removed")
    )
