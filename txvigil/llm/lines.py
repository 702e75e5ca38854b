"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. It goes if an earlier line (by document id, then line
number) has a Jaccard similarity of at least ``THRESHOLD`` percent, whether or not that one
goes too. Words are ordered by rarity; the rarest word two similar lines share is one of the
first few of both (prefix filter), so near to the front that enough words can follow
(positional filter), and they have nearly as many words (length filter). What passes is
verified on the words themselves.

Equal lines are put together before anything is joined. Words that occur once in all texts
make no rows. Lines that share a light word, one of few occurrences, are compared in one join,
in which the smaller set needs the word in its still shorter index prefix. For other prefix words
the join is with the earliest line that has them. A line is first verified against the earliest
of its candidates; only lines that this does not remove are then compared with the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from txvigil.llm.common import beside, discard, stored, unused

THRESHOLD = 80
# The table of word counts has 2 ** SLOT_BITS slots of a byte, in chunks of 2 ** CHUNK_BITS. All
# words are counted, by hash: a rare word may look more frequent than it is, which costs
# candidates, never results.
SLOT_BITS, CHUNK_BITS = 22, 12
# Words of at most so high a level occur less than 2 ** LIGHT times, in as few lines.
LIGHT = 10
_NULL = -(1 << 63)
_SPACE = r"[\x09-\x0D]"
_PLACE = ("doc", "line")


def words(content: Column) -> Column:
    # Splitting at one character needs no regular expression.
    spaced = F.when(content.rlike(_SPACE), F.regexp_replace(content, _SPACE, " ")).otherwise(content)
    return F.array_remove(F.split(spaced, " "), "")


def split_lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, line, content) of every line; a null id is the smallest one."""
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL))
    lines = F.posexplode(F.split(F.col(text), "\n")).alias("line", "content")
    return docs.select(key.alias("doc"), lines)


def _slot(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - SLOT_BITS).cast("int")


def _filled(entries: Column, at: str, text: str, width: int, length: int) -> Column:
    """One text of entries of ``width`` digits, those that are missing "0"."""

    def piece(entry: Column, i: Column) -> Column:
        before = F.when(i > 0, F.get(entries, i - 1)[at]).otherwise(F.lit(-1))
        return F.concat(F.repeat(F.lit("0"), (entry[at] - before - 1) * width), entry[text])

    return F.rpad(F.array_join(F.transform(entries, piece), ""), length, "0")


def level_table(docs: DataFrame, text: str) -> DataFrame:
    """Logarithm of the count of each slot of words: one row, a byte each, of fixed size.

    Every chunk of the table is put together where it is counted, as a text of digits from "0" on.
    """
    word = F.explode(words(F.replace(F.col(text), F.lit("\n"), F.lit(" ")))).alias("word")
    counts = docs.select(word).groupBy(_slot(F.xxhash64("word")).alias("slot")).count()
    digit = F.char(F.length(F.bin("count")) + 48)
    place = F.col("slot").bitwiseAND(F.lit((1 << CHUNK_BITS) - 1))
    used = F.sort_array(F.collect_list(F.struct(place.alias("at"), digit.alias("text"))))
    chunks = counts.groupBy(F.shiftright("slot", CHUNK_BITS).alias("chunk")).agg(used.alias("used"))
    packed = _filled(F.col("used"), "at", "text", 1, 1 << CHUNK_BITS)
    chunks = chunks.select("chunk", packed.alias("packed"))
    parts = chunks.agg(F.sort_array(F.collect_list(F.struct("chunk", "packed"))).alias("parts"))
    levels = _filled(F.col("parts"), "chunk", "packed", 1 << CHUNK_BITS, 1 << SLOT_BITS)
    return parts.select(levels.cast("binary").alias("levels"))


def word_levels(docs: DataFrame, text: str) -> Column:
    """The table as a constant, for small uses: plans that hold it are described with all its bytes."""
    return F.lit(bytearray(level_table(docs, text).first().levels))


def by_rarity(content: Column, levels: Column) -> Column:
    """Distinct words of a line as numbers, rarest first.

    Rarity is the level of the word's count; the hash breaks ties and tells words apart.
    """

    def number(hashed: Column) -> Column:
        level = F.ascii(F.substring(levels, _slot(hashed) + 1, 1).cast("string")) - 48
        # Never null, so that numbers are sorted as such.
        level = F.coalesce(level.cast("long"), F.lit(0).cast("long"))
        return F.shiftleft(level, 57).bitwiseOR(hashed.bitwiseAND(F.lit((1 << 57) - 1)))

    hashes = F.transform(words(content), lambda word: F.xxhash64(word))
    return F.sort_array(F.array_distinct(F.transform(hashes, number)))


def repeated(word: Column) -> Column:
    """Whether another line may have this prefix word: not if it occurs once in all texts."""
    return (word < 0) | (F.shiftright(word, 57) > 1)


def light(word: Column) -> Column:
    return (word >= 0) & (F.shiftright(word, 57) <= LIGHT)


def prefix_length(n: Column, threshold: int) -> Column:
    return F.floor(n * (100 - threshold) / 100).cast("int") + 1


def signed(lines: DataFrame, levels: DataFrame, threshold: int) -> DataFrame:
    """Adds the size ``n``, the ``prefix`` words and ``bits`` (parity of the words' hashes).

    The table of word counts is read as a subquery: it is in no plan, nor in what describes one.

    Lines of so few words that only equal sets are similar have their whole set as prefix.
    """
    lines = lines.withColumn("_levels", levels.scalar())
    lines = lines.withColumn("_words", by_rarity(F.col("content"), F.col("_levels"))).drop("_levels")
    n = F.size("_words")
    whole = F.array(-F.abs(F.xxhash64("_words").bitwiseAND(F.lit((1 << 62) - 1))) - 1)
    front = F.slice("_words", 1, prefix_length(n, threshold))
    prefix = F.when((n + 1) * threshold > n * 100, whole).otherwise(front)
    bits = F.aggregate("_words", F.lit(0).cast("long"), lambda mask, w: mask.bitwiseXOR(_bit(w)))
    return lines.select("*", n.alias("n"), bits.alias("bits"), prefix.alias("prefix")).drop("_words")


def _bit(word: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), word.bitwiseAND(F.lit(63)).cast("int"))


def candidates(rows: DataFrame, threshold: int) -> DataFrame:
    """(a_doc, a_line, b_doc, b_line) of pairs that may be similar.

    Rows are pairs, once for each prefix word they share, with its place in both. The first
    word a similar pair shares passes the positional filter, so one of its rows is kept.
    """
    a, b = F.col("a_n"), F.col("b_n")
    alike = 100 * F.least(a, b) >= threshold * F.greatest(a, b)
    most = F.least(a - F.col("a_at"), b - F.col("b_at"))
    alike = alike & ((100 + threshold) * most >= threshold * (a + b))
    # The sets differ in at least as many words as their parities in bits.
    differ = F.bit_count(F.col("a_bits").bitwiseXOR(F.col("b_bits")))
    alike = alike & ((100 + threshold) * differ <= (100 - threshold) * (a + b))
    return rows.filter(alike).select("a_doc", "a_line", "b_doc", "b_line").distinct()


def light_pairs(rows: DataFrame, threshold: int) -> DataFrame:
    """(a_doc, a_line, b_doc, b_line), a earlier, of lines that share a light word and may be similar.

    The first word a similar pair shares is in the index prefix of the smaller set. A light word
    has few rows, so its pairs are few for each row.
    """
    index = F.floor(F.col("n") * (100 - threshold) / (100 + threshold))
    smaller, larger = [
        side.withColumnsRenamed({c: f"{name}_{c}" for c in rows.columns if c != "word"})
        for name, side in (("a", rows.filter(F.col("at") <= index)), ("b", rows))
    ]
    ordered = F.struct("a_n", "a_doc", "a_line") < F.struct("b_n", "b_doc", "b_line")
    a, b = [F.struct(*[F.col(f"{side}_{c}").alias(c) for c in _PLACE]) for side in "ab"]
    pairs = candidates(smaller.join(larger, "word").filter(ordered), threshold)
    pairs = pairs.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    return pairs.select([F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "ab" for c in _PLACE])


def verified(pairs: DataFrame, docs: DataFrame, doc_id: str, text: str, threshold: int) -> DataFrame:
    """Later lines (doc, line) of those pairs whose words really are similar."""
    places = pairs.select("a_doc", "a_line").union(pairs.select("b_doc", "b_line"))
    places = places.toDF(*_PLACE).groupBy("doc").agg(F.collect_set("line").alias("_places"))
    places = stored(places)
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL))
    # Only the lines that are asked for are taken out of a text.
    found = docs.select(key.alias("doc"), F.split(F.col(text), "\n").alias("_all"))
    found = found.join(beside(places), "doc").select(
        "doc", F.inline(F.transform("_places", lambda i: F.struct(i.alias("line"), F.get("_all", i).alias("content"))))
    )
    contents = stored(found.filter("content IS NOT NULL"))
    for side in ("a", "b"):
        names = [f"{side}_{c}" for c in _PLACE]
        pairs = pairs.join(contents.toDF(*names, f"{side}_content"), names)
    sides = [
        F.array_distinct(F.transform(words(F.col(f"{side}_content")), lambda w: F.xxhash64(w)))
        for side in ("a", "b")
    ]
    pairs = pairs.select("b_doc", "b_line", *[w.alias(n) for w, n in zip(sides, "ab", strict=True)])
    both = F.size(F.array_intersect("a", "b"))
    similar_ = 100 * both >= threshold * (F.size("a") + F.size("b") - both)
    similar_lines = stored(pairs.filter(similar_).select("b_doc", "b_line").distinct().toDF(*_PLACE))
    discard(contents)
    discard(places)
    return similar_lines


def duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """(doc, lines): the numbers of the lines that go, per document that loses any.

    Lines without a word stay. Rows that repeat a document id are one place: what goes from
    one goes from all. Null texts have no lines; an empty table loses nothing.
    """
    levels = stored(level_table(docs, text), free=True)
    lines = split_lines(docs, doc_id, text)
    worded = lines.filter(F.btrim("content", F.lit(" \t\n\x0b\f\r")) != "")
    equal = [F.xxhash64("content").alias("h"), F.xxhash64(F.lit(1), "content").alias("g")]

    once = signed(worded, levels, threshold).select("*", *equal).groupBy("h", "g").agg(
        F.min(F.struct(*_PLACE)).alias("place"),
        F.count("*").alias("times"),
        F.first(F.struct("n", "bits", "prefix")).alias("signed"),
    )
    once = stored(once.select("h", "g", "place.*", "times", "signed.*"), free=True)
    discard(levels)
    own = (*_PLACE, "at", "n", "bits")
    rows = once.select(F.posexplode("prefix").alias("at", "word"), *_PLACE, "n", "bits")
    rows = rows.filter(repeated(F.col("word")))
    near = stored(light_pairs(rows.filter(light(F.col("word"))), threshold), free=True)
    rows = rows.filter(~light(F.col("word")))
    # Words of one line make no pairs; lines of the others also see the earliest.
    hubs = rows.groupBy("word").agg(F.min(F.struct(*own)).alias("hub"), F.count("*").alias("rows"))
    hubs = hubs.filter("rows > 1").select(
        F.col("word"), "rows", *[F.col(f"hub.{c}").alias(f"a_{c}") for c in own]
    )
    hubs = stored(hubs, free=True)
    earlier = F.struct("a_doc", "a_line") < F.struct("b_doc", "b_line")
    shared = stored(rows.join(hubs, "word").filter(F.struct("a_doc", "a_line") < F.struct(*_PLACE)), free=True)
    discard(hubs)
    first = shared.withColumnsRenamed({c: f"b_{c}" for c in own})
    earliest = near.groupBy("b_doc", "b_line").agg(F.min(F.struct("a_doc", "a_line")).alias("a"))
    earliest = earliest.select("a.*", "b_doc", "b_line")
    first = stored(candidates(first, threshold).union(earliest), free=True)
    gone = verified(first, docs, doc_id, text, threshold)

    # What is compared now has not been with an earliest line: heavy words of three lines or more,
    # and further candidates of light words.
    # Lines that are gone need no further match, so they are no later ones.
    left = shared.filter("rows > 2").select("word", *own)
    after = left.join(beside(gone), [*_PLACE], "left_anti")
    sides = [
        rows.withColumnsRenamed({c: f"{side}_{c}" for c in own})
        for side, rows in (("a", left), ("b", after))
    ]
    pairs = sides[0].join(sides[1], "word")
    near_left = near.join(beside(gone.toDF("b_doc", "b_line")), ["b_doc", "b_line"], "left_anti")
    more = candidates(pairs.filter(earlier), threshold).union(near_left.select(near.columns))
    more = stored(more.join(first, first.columns, "left_anti"), free=True)
    gone = stored(gone.union(verified(more, docs, doc_id, text, threshold)).distinct())
    for done in (shared, near, first, more):
        discard(done)

    repeats = once.select("h", "g", *_PLACE, "times").join(
        beside(gone.withColumn("gone", F.lit(True))), [*_PLACE], "left"
    )
    repeats = stored(
        repeats.filter("times > 1 OR gone").select(
            "h", "g", F.col("doc").alias("_doc"), F.col("line").alias("_line"),
            F.coalesce("gone", F.lit(False)).alias("gone"),
        )
    )
    discard(once)
    found = worded.select(*_PLACE, *equal).join(beside(repeats), ["h", "g"])
    found = found.filter("gone OR doc <> _doc OR line <> _line")
    return stored(found.groupBy("doc").agg(F.collect_set("line").alias("lines")))


def deduped(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD
) -> DataFrame:
    """All rows with their remaining lines, and ``n_lines`` and ``n_removed``.

    A null text stays null and has no lines, an empty one has one line and stays; an empty
    table stays empty. Further columns stay as they are, but for two of these two names.
    """
    gone = duplicates(docs, doc_id, text, threshold)
    doc, lost = unused("_doc", docs.columns), unused("_lines", docs.columns)
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(_NULL))
    joined = docs.withColumn(doc, key).join(beside(gone.toDF(doc, lost)), doc, "left")
    lines = F.split(F.col(text), "\n")
    none = F.array().cast("array<int>")
    removed = F.coalesce(lost, none)
    kept = F.filter(lines, lambda _, i: ~F.array_contains(removed, i))
    return joined.withColumns(
        {
            text: F.when(F.size(removed) > 0, F.array_join(kept, "\n")).otherwise(F.col(text)),
            "n_lines": F.coalesce(F.size(lines), F.lit(0)).cast("long"),
            "n_removed": F.size(removed).cast("long"),
        }
    ).drop(doc, lost)
