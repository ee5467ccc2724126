"""Line deduplication by an exact set-similarity join, in DataFrame functions only.

A line is the set of its lower-cased words.  A line that holds a word is removed
if an earlier line (of a lower doc_id, or above it in its document) has the same
set or one of Jaccard similarity 0.75 or more.

Join.  Words are ordered by rarity, rare first: the frequencies of all words, counted in ``CELLS`` hashed cells, give each
word a level, a quarter of a power of two wide; the word's hash breaks ties.  Of a set of n words the first
``n - ceil(3 n / 4) + 1`` can be the first that it shares with a similar one (prefix filter).  Sets meet at those of them that
are not known to occur once and are rarer than ``COMMON``.  If such a prefix reaches the common words, the sets also meet at pairs of words
that are neighbours in the order, from the first common word on: among ``2 floor(n / 4) + 2`` of them a similar
pair whose first shared word is common has one that both hold, since each word that only one of them has parts one pair of neighbours.
So no meeting at a single word grows beyond the lines that ``COMMON`` allows, and a meeting at two common words is a selective one.
Of the sets that meet, pairs are kept whose sizes fit (length filter), whose places allow the overlap (positional
filter) and whose parity bitmaps differ in no more bits than words may; these are verified on the whole sets.

Scale.  Equal sets enter once, numbered in document order.  A group of near copies is collapsed first: lines that share one of their
first ``FORE`` entries, or two neighbouring ones of the first ``LINKS + 1``, are held against the earliest of them alone, and what that
covers needs no earlier line any more.  The join then seeks earlier lines for the others only; it runs in ``ROUNDS`` slices of its keys,
so that the disk holds the shuffle of one, which both sides of the join read.
Only numbers are shuffled, texts are not, except to verify more lines than ``BROADCAST_LINES`` or ``BROADCAST_DOCS`` allow.

Defined cases: a null or empty text, and a line without words, keep what they have; sets of one or
two words match equal sets only; documents that repeat an id and a text are judged
alike; a null id comes first; an empty table stays empty; other columns are left alone, whatever they are called.
Sets and words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, shielded, stored

#: Cells that words are counted in.
CELLS = 1 << 18
#: Occurrences from which a word is common: lines meet at pairs of such words.
COMMON = 1024
#: Sets of up to so many words have bitmaps of 64 and 128 bits, larger ones of 256.
SMALL, MIDDLE = 48, 112
#: Entries, and pairs of neighbouring entries, of a line by which it meets the earliest line that has them; slices of the join.
FORE, LINKS, ROUNDS = 2, 5, 3
#: Lines to verify and documents that hold them which may be broadcast; beyond either they are joined by a shuffle.
BROADCAST_LINES, BROADCAST_DOCS = 2_000_000, 300_000
_REGEX = r"[\\x20\\x09-\\x0D]+"


#: SQL for whether a text has white space besides blanks and line ends.
RARE = " or ".join(f"contains(text, chr({c}))" for c in (9, 11, 12, 13))


def words(line: str, rare: str = "rare") -> str:
    """SQL for the words of a string expression, lower-cased; without rare white space it is split by blanks, which is faster."""
    return f"array_remove(if({rare}, split(lower({line}), '{_REGEX}'), split(lower({line}), ' ')), '')"


def level(count: int) -> int:
    """Rarity of a cell: 0 for words that occur once at most, then a step for each quarter of a power of two."""
    return 0 if count < 2 else (count**4).bit_length()


def levels(docs: DataFrame) -> str:
    """SQL for an array with the level of each cell, from the counts of all words of all texts; its length is fixed."""
    held = docs.select(F.expr("replace(text, chr(10), ' ')").alias("text"), F.expr(RARE).alias("rare")).select(F.explode(F.expr(words("text"))).alias("w"))
    counted = held.select(F.expr(f"cast(xxhash64(w) & {CELLS - 1} as int)").alias("cell")).groupBy("cell").agg(F.count("*").alias("n"))
    step = F.when(F.col("n") < 2, 0).otherwise(F.floor(F.log2("n") * 4) + 1)
    both = counted.select("cell", step.cast("int").alias("level")).unionByName(docs.sparkSession.range(0, CELLS, 1, 8).selectExpr("cast(id as int) as cell", "0 as level"))
    row = both.groupBy("cell").agg(F.max("level").alias("level")).agg(F.sort_array(F.collect_list(F.struct("cell", "level"))).alias("all"))  # CELLS rows
    text = row.select(F.array_join(F.transform("all", lambda x: x["level"].cast("string")), ",")).first()[0]
    return f"from_json('[{text}]', 'array<int>')"


#: Low bits of an ordered word that are its hash; the level stands above them.
_HASH = (1 << 56) - 1
#: An entry: 42 bits of key, one that tells pairs of words from words, 20 of the place.
_KEY, _PAIR, _PLACE = (1 << 42) - 1, 1 << 20, (1 << 20) - 1
SIGNS = ["s1", "s2", "s3", "s4"]


def bits() -> list[str]:
    """SQL for four words of a parity bitmap of the array w: 64 bits for up to ``SMALL`` words, 128 for up to ``MIDDLE``, else 256."""
    one = "aggregate({}, 0L, (s, x) -> s ^ shiftleft(1L, cast(x & 63 as int)))"
    part = lambda of, k: one.format(f"filter(w, x -> (x & {64 * (of - 1)}) = {64 * k})")
    return [
        f"case when n <= {SMALL} then {one.format('w')} when n <= {MIDDLE} then {part(2, 0)} else {part(4, 0)} end",
        f"case when n <= {SMALL} then 0L when n <= {MIDDLE} then {part(2, 1)} else {part(4, 1)} end",
        f"case when n <= {MIDDLE} then 0L else {part(4, 2)} end",
        f"case when n <= {MIDDLE} then 0L else {part(4, 3)} end",
    ]


def line_table(docs: DataFrame) -> DataFrame:
    """A row for each line: doc_id, th (hash of the text), line, sid (digest of its set), n; for sets of three words and more also
    s1 to s4 (bitmap) and keys (entries, rare words first)."""
    common = level_of(COMMON) << 56
    rows = docs.select("doc_id", "th", F.coalesce("text", F.lit("")).alias("text")).withColumn("rare", F.expr(RARE))  # once for a text, not for each line
    rows = rows.select("doc_id", "th", "rare", F.posexplode(F.split("text", "\n", -1)).alias("line", "value"))
    rows = rows.select("doc_id", "th", "line", F.expr(words("value")).alias("v"))
    word = f"shiftleft(cast(coalesce(get({levels(docs)}, cast(h & {CELLS - 1} as int)), 0) as bigint), 56) | shiftrightunsigned(h, 8)"
    rows = rows.select("doc_id", "th", "line", F.expr(f"sort_array(array_distinct(transform(transform(v, x -> xxhash64(x)), h -> {word})))").alias("w"))
    rows = rows.select("*", F.size("w").alias("n"))
    first = f"filter(transform(slice(w, 1, shiftright(n, 2) + 1), (x, i) -> if(x > {_HASH} and x < {common}, shiftleft(x & {_KEY}, 21) | least(i, {_PLACE}), -1L)), x -> x >= 0)"
    start = f"size(filter(slice(w, 1, shiftright(n, 2) + 1), x -> x < {common}))"
    end = "least(2 * shiftright(n, 2) + 1, n - 2)"
    pairs = f"case when get(w, shiftright(n, 2)) >= {common} and {start} <= {end} then transform(sequence({start}, {end}), p -> shiftleft(xxhash64(get(w, p), get(w, p + 1)) & {_KEY}, 21) | {_PAIR} | least(p, {_PLACE})) else cast(array() as array<bigint>) end"
    big = {k: f"case when n >= 3 then {v} end" for k, v in zip([*SIGNS, "keys"], [*bits(), f"concat({first}, {pairs})"], strict=True)}
    return rows.select("doc_id", "th", "line", "n", F.xxhash64("w").alias("sid"), *[F.expr(v).alias(k) for k, v in big.items()])


def level_of(count: int) -> int:
    return level(count)


#: Words that sets of na and nb words may have for themselves at the threshold, both together.
_SPARE = "(na + nb - 2 * ((3 * (na + nb) + 6) div 7))"
#: Length filter.
FITS = "4 * na >= 3 * nb and 4 * nb >= 3 * na"
#: Positional filter of entries at pa and pb: no more words may stand before the first shared one, or before the first shared
#: neighbours, than the sets may have for themselves.
PLACED = "if(paired, 7 * (2 * na + nb - pa) >= 9 * (na + nb) and 7 * (2 * nb + na - pb) >= 9 * (na + nb), 7 * (na - pa) >= 3 * (na + nb) and 7 * (nb - pb) >= 3 * (na + nb))"
#: Bitmap filter: a word that only one set has turns one bit, so more differing bits than such words that are allowed rule a pair out.
_X = {k: f"({k}a ^ {k}b)" for k in SIGNS}
_BITS = [" ^ ".join(_X.values()), f"{_X['s1']} ^ {_X['s3']}", f"{_X['s2']} ^ {_X['s4']}"]
ALIKE = f"bit_count({_BITS[0]}) <= {_SPARE} and (na <= {SMALL} or nb <= {SMALL} or bit_count({_BITS[1]}) + bit_count({_BITS[2]}) <= {_SPARE} and (na <= {MIDDLE} or nb <= {MIDDLE} or {' + '.join(f'bit_count({x})' for x in _X.values())} <= {_SPARE}))"


def led(sets: DataFrame) -> DataFrame:
    """Pairs a, b: b and the earliest set a that has one of its first ``FORE`` entries among its own, or two neighbouring ones of its
    first ``LINKS + 1``, wherever they stand."""
    key = "transform(keys, e -> shiftright(e, 20))"
    links = f"case when size(k) > 1 then transform(sequence(0, least(size(k) - 2, {LINKS - 1})), i -> xxhash64(get(k, i), get(k, i + 1))) else cast(array() as array<bigint>) end"
    fore = sets.where("n >= 3").select("id", "n", F.expr("s1 ^ s2 ^ s3 ^ s4").alias("s"), F.expr(key).alias("k"))  # 64 bits of the bitmap will do here
    fore = fore.select("id", "n", "s", F.explode(F.expr(f"concat(slice(k, 1, {FORE}), {links})")).alias("key")).where("id is not null and n is not null and s is not null and key is not null").repartition("key")
    lead = fore.groupBy("key").agg(F.min("id").alias("ida"), F.min_by("n", "id").alias("na"), F.min_by("s", "id").alias("sa"), F.count("*").alias("times")).where("times > 1").withColumnRenamed("key", "k")
    rows = fore.select("key", *[F.col(c).alias(f"{c}b") for c in ("id", "n", "s")])
    return lead.join(rows, F.expr(f"k = key and ida < idb and {FITS} and bit_count(sa ^ sb) <= {_SPARE}")).selectExpr("ida as a", "idb as b").distinct()


def met(sets: DataFrame, covered: DataFrame, k: int, rounds: int) -> DataFrame:
    """Pairs a, b of sets that meet in slice k, a before b, b not covered."""
    rows = sets.where("n >= 3").join(covered.select(F.col("late").alias("id"), F.lit(0).alias("open")), "id", "left")
    rows = rows.select("id", "n", *SIGNS, F.coalesce("open", F.lit(1)).alias("open"), F.explode("keys").alias("e")).where(f"pmod(shiftright(e, 21), {rounds}) = {k}")
    # The place and, in the last bit, whether earlier sets are sought: both sides are alike, so that they share one shuffle.
    rows = rows.select(F.expr("shiftright(e, 20)").alias("key"), F.expr(f"cast(e & {_PLACE} as int) * 2 + open").alias("p"), "id", "n", *SIGNS)
    one, two = (rows.select(*[F.col(c).alias(f"{c}{x}") for c in rows.columns]) for x in "ab")
    placed = PLACED.replace("pa", "shiftright(pa, 1)").replace("pb", "shiftright(pb, 1)").replace("shiftright(pa, 1)ired", "paired")
    sought = "(pb & 1 = 1 or ida < 0)"  # no id is negative; a filter of one side alone would part the sides
    fits = f"keya = keyb and ida < idb and {sought} and {FITS} and {placed} and {ALIKE}".replace("paired", "keya & 1 = 1")
    return one.join(two, F.expr(fits)).selectExpr("ida as a", "idb as b").distinct()


def similar(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """late: b of the pairs a, b whose whole sets reach the threshold."""
    needed = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    places = sets.select("id", "first.*").join(needed, "id").groupBy("doc_id", "th").agg(F.collect_list(F.struct("id", "line")).alias("own"))
    places = stored(places.toDF("d", "t", "own"), "places")
    size = places.agg(F.count("*").alias("docs"), F.coalesce(F.sum(F.size("own")), F.lit(0)).alias("lines")).first()
    wanted = F.broadcast(places) if size["docs"] <= BROADCAST_DOCS and size["lines"] <= BROADCAST_LINES else places
    rows = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t"))).select(F.expr(RARE).alias("rare"), F.split("text", "\n", -1).alias("lines"), F.explode("own").alias("x"))
    rows = rows.select("rare", "x.id", F.expr("get(lines, x.line)").alias("line"))
    whole = rows.select("id", F.expr(f"array_distinct(transform({words('line')}, x -> xxhash64(x)))").alias("w")).dropDuplicates(["id"])
    whole = stored(whole, "whole")
    one, two = (whole.select(F.col("id").alias(x), F.col("w").alias(f"w{x}")) for x in "ab")
    discard(places)
    found = pairs.join(one, "a").join(two, "b").where("7 * size(array_intersect(wa, wb)) >= 3 * (size(wa) + size(wb))").select(F.col("b").alias("late")).distinct()
    found = stored(found, "similar")
    discard(whole)
    return found


def packed(table: DataFrame) -> str | None:
    """SQL for a number that keeps the order of places, out of the id of the document and the line; None where ids are null, negative,
    too large or shared by different texts, so that the places must be sorted."""
    ids = table.where("line = 0").groupBy("doc_id").agg((F.min("th") != F.max("th")).alias("shared"))
    odd = F.coalesce(F.max(F.expr("shared or doc_id is null or doc_id < 0")), F.lit(False))
    ids = ids.agg(odd.alias("odd"), F.coalesce(F.max("doc_id"), F.lit(0)).alias("most")).first()
    bits = int(table.agg(F.coalesce(F.max("line"), F.lit(0))).first()[0]).bit_length()
    return None if ids["odd"] or int(ids["most"]).bit_length() + bits > 62 else f"shiftleft(first.doc_id, {bits}) + first.line"


def few(rows: DataFrame, most: int) -> DataFrame:
    """The rows, to be broadcast unless there are more than ``most``."""
    return F.broadcast(rows) if rows.count() <= most else rows


def removals(docs: DataFrame) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): doc_id, th, n_lines (lines that hold a word) and removed (their numbers, from 0)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    table = stored(line_table(docs), "lines")
    place = F.struct("doc_id", "th", "line")
    sets = table.where("n > 0").groupBy("sid").agg(F.min(place).alias("first"), F.first("n").alias("n"), F.first(F.struct("keys", *SIGNS)).alias("x"))
    number = packed(table)
    discard()
    # Numbered in document order, and stored, so that the numbers stay.
    sets = sets.withColumn("id", F.expr(number)) if number else sets.orderBy("first").withColumn("id", F.monotonically_increasing_id())
    sets = stored(sets.select("id", "sid", "first", "n", "x.*"), "sets")
    lines = stored(table.select("doc_id", "th", "line", F.when(F.col("n") > 0, F.col("sid")).alias("sid")), "places")
    discard(table)
    pairs = stored(led(sets), "led")
    discard()
    late = similar(docs, sets, pairs)
    discard(pairs)
    found, covered = [], few(late, BROADCAST_LINES)
    for k in range(ROUNDS):
        found.append(stored(met(sets, covered, k, ROUNDS), "met"))
        discard()
    pairs = found[0]
    for x in found[1:]:
        pairs = pairs.unionByName(x)
    late = late.unionByName(similar(docs, sets, pairs.distinct())).distinct()
    discard(*found)
    known = sets.select("sid", "id", "first").join(late.select(F.col("late").alias("id"), F.lit(True).alias("late")), "id", "left")
    marked = lines.where("sid is not null").join(known, "sid")
    gone = F.col("late").isNotNull() | (place != F.col("first"))
    removed = marked.groupBy("doc_id", "th").agg(F.count_distinct("line").alias("n_lines"), F.sort_array(F.collect_set(F.when(gone, F.col("line")))).alias("removed")).toDF("d", "t", "n_lines", "removed")
    rows = lines.where("line = 0").select("doc_id", "th").join(removed, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("t") == F.col("th")), "left")
    return rows.select("doc_id", "th", F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_removed and removed_lines (numbers of the removed lines from 0, comma-joined) of every document."""
    return removals(docs).select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` without the removed lines in ``text``; a document of which every line with a word is removed goes.

    All other columns, and the order of what stays, are as they were.
    """
    found = stored(removals(docs).distinct(), "removed").where("size(removed) > 0").toDF("weft_d", "weft_t", "weft_n", "weft_r")
    safe, names = shielded(docs, found.columns)
    rows = safe.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("weft_d")) & (F.xxhash64("text") == F.col("weft_t")), "left").where("weft_r is null or size(weft_r) < weft_n")
    kept = F.expr("array_join(filter(split(text, '\\n', -1), (x, i) -> not array_contains(weft_r, i)), '\\n')")
    return rows.withColumn("text", F.when(F.col("weft_r").isNull(), F.col("text")).otherwise(kept)).select(*safe.columns).toDF(*names)
