"""Near-duplicate lines through a segment-partition edit join. Only DataFrame and SQL functions are used.

Lines are sequences of words, and an edit inserts, deletes or replaces one. The more words a line has the more edits may part
it from a near one. The shorter line of a pair is cut into ``threshold + 1`` segments of one length. A partner within the
threshold contains at least one of them unchanged, shifted by no more than the edits on either side allow, so every line is
indexed by its segments and probed by those of its runs of words that can stand for a segment of a line at most ``threshold``
words shorter. Lines of neighbouring sizes are cut alike, so that most of these runs are the same and come up once. Candidates
are verified with a bit-parallel edit distance that keeps only the diagonals within the threshold.

Keys that many lines have are split by words: of the words of two near lines, taken from the rarest on, the first that both
have is among the first ``threshold + 1`` of either. In each part lines are linked to the one with the most common words
first, and only lines that no chain of links connects are then compared with one another.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovane.llm.common import let, stored
from heliovane.llm.components import connected_components

#: Words from which lines may differ in so many edits; lines of fewer words are near only to themselves.
THRESHOLDS = ((5, 1), (16, 2))

#: Index entries of a key that are joined as they are. Larger keys are split.
KEY_LIMIT = 2

#: Candidate lines whose ids are broadcast; beyond it their texts are found with a shuffle join.
BROADCAST_LINES = 1_000_000

#: Numbers of 64 bits in the sketch of a line.
SKETCH_NUMBERS = 4

Thresholds = tuple[tuple[int, int], ...]

_LINE_NUMBERS = 1 << 32
#: Above every id.
_NO_ID = str(1 << 63)


def line_occurrences(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text_hash, line_no, place, line`` for every line that is not blank, without the white space around it.
    ``place`` orders lines by document and number, null ids last."""
    text = F.col(f"`{text_column}`")
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("line_no", "raw"),
    )
    # Trimming several kinds of white space is slow, and few lines need it.
    white = [" ", "\t", "\r"]
    padded = reduce(or_, [end for w in white for end in (F.startswith("raw", F.lit(w)), F.endswith("raw", F.lit(w)))])
    trimmed = F.btrim("raw", F.lit("".join(white)))
    rows = rows.withColumn("line", F.when(padded, trimmed).otherwise(F.col("raw")))
    order = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), F.lit(_NO_ID).cast("decimal(20,0)"))
    place = (order * F.lit(_LINE_NUMBERS) + F.col("line_no")).cast("decimal(38,0)")
    return rows.where("line <> ''").select("doc_id", "text_hash", "line_no", place.alias("place"), "line")


def words_of(line: Column) -> Column:
    """The words of a line; two blanks have an empty one between them, so that equal words mean equal lines."""
    return F.split(line, " ")


def threshold_of(words: Column, thresholds: Thresholds) -> Column:
    """Edits that may part a line of so many words from a near one of as many or more."""
    steps = sorted(thresholds, reverse=True)
    return reduce(lambda column, step: column.when(words >= step[0], step[1]), steps, F.when(F.lit(False), 0)).otherwise(0)


def _identity(line: Column) -> list[Column]:
    """128 bits that stand for a line."""
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("line"), line).alias("h2")]


def _least_size(size: Column, thresholds: Thresholds) -> Column:
    """The smallest size of those that are cut like a line of this one: sizes from a power of two on to the next are taken in
    four or more classes, none of more than 16 sizes or with two thresholds."""
    width = F.when(size < 8, 1)
    for power in (8, 16, 32):
        width = width.when(size < 2 * power, power // 4)
    width = width.otherwise(16)
    starts = sorted(thresholds, reverse=True)
    start = reduce(lambda column, step: column.when(size >= step[0], step[0]), starts, F.when(F.lit(False), 0)).otherwise(0)
    return F.greatest(F.floor(size / width) * width, start).cast("int")


def _pieces(thresholds: Thresholds) -> list[tuple[int, int, int, int, int | None]]:
    """``threshold, segment, shorter, shift, before``: where the segments of a line of the same size, or up to the threshold
    shorter, can be found.

    With ``d`` the difference in size and ``t`` the threshold, segment ``k`` (from 0) can be shifted by at most ``k`` edits
    before it and by at most ``t - k`` after it, whichever leaves fewer positions. The last one is looked for at the end of
    the line. ``before`` is the next smaller difference with the same shift.
    """

    def shifts(t: int, k: int, d: int) -> range:
        return range(max(-k, d - t + k), min(k, d + t - k) + 1) if k < t else range(1)

    found = []
    for t in _edits(thresholds):
        for k in range(t + 1):
            for d in range(t + 1):
                for shift in shifts(t, k, d):
                    before = max((e for e in range(d) if shift in shifts(t, k, e)), default=None)
                    found.append((t, k, d, shift, before))
    return found


def line_keys(lines: DataFrame, thresholds: Thresholds) -> DataFrame:
    """``key, line_id, own`` for each line (``line_id, line, size``) and each run of its words that may stand for a segment of
    a near line that is not longer. ``own`` tells the line's own segments.

    Lines of a class of sizes are cut alike, by the smallest of them: into segments of one length from the start on and the last
    one at the end. The key hashes the class, the segment's number and the words.
    """
    names = ("t", "k", "d", "shift", "before")
    given = [
        F.struct(*[F.lit(v).cast("int").alias(n) for v, n in zip(piece, names, strict=True)]) for piece in _pieces(thresholds)
    ]
    rows = lines.select("line_id", "line", "size", F.explode(F.array(*given)).alias("piece"))
    t, k, shift = F.col("piece.t"), F.col("piece.k"), F.col("piece.shift")
    of_size, earlier = F.col("size") - F.col("piece.d"), F.col("size") - F.col("piece.before")
    least = _least_size(of_size, thresholds)
    # The same run for a larger difference is the same key if the sizes are of one class.
    again = F.col("piece.before").isNotNull() & (_least_size(earlier, thresholds) == least)
    again = again & (threshold_of(earlier, thresholds) == t)
    rows = rows.where((threshold_of(of_size, thresholds) == t) & ~again)
    rows = rows.withColumn("least", least).withColumn("length", F.floor(F.col("least") / (t + 1)).cast("int"))

    def cut(text: Column, words: Column) -> Column:
        """The first words, or the last ones for a negative number."""
        return F.call_function("substring_index", text, F.lit(" "), words)

    length = F.col("length")
    inner = cut(cut(F.col("line"), (k + 1) * length + shift), -length)
    run = F.when(k == 0, cut(F.col("line"), length)).when(k == t, cut(F.col("line"), -length)).otherwise(inner)
    own = (F.col("piece.d") == 0) & (shift == 0)
    return rows.select(F.xxhash64(t, k, "least", run).alias("key"), "line_id", own.alias("own"))


def _edits(thresholds: Thresholds) -> list[int]:
    return sorted({t for _, t in thresholds})


def hashes_of(line: Column) -> Column:
    return F.transform(words_of(line), lambda word: F.xxhash64(word))


def sketch(hashes: Column) -> Column:
    """256 bits in four numbers, each the parity of how often the words of its class occur: one edit flips at most two."""

    def flip(bits: Column, word: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), word.bitwiseAND(F.lit(63)).cast("int"))
        number = F.shiftright(word, 6).bitwiseAND(F.lit(SKETCH_NUMBERS - 1))
        return F.transform(bits, lambda b, k: F.when(k == number, b.bitwiseXOR(bit)).otherwise(b))

    return F.aggregate(hashes, F.array(*[F.lit(0).cast("bigint")] * SKETCH_NUMBERS), flip)


def flips(a: Column, b: Column) -> Column:
    """In how many bits two sketches differ."""
    return sum((F.bit_count(a[k].bitwiseXOR(b[k])) for k in range(SKETCH_NUMBERS)), F.lit(0))


def banded_distance(a: Column, b: Column, threshold: int) -> Column:
    """Edit distance of two arrays if it is at most ``threshold``, else something larger.

    Two words hold the vertical differences of the ``2 * threshold + 1`` diagonals around the main one, the lowest
    diagonal in the top bit. One step per element of ``b`` moves this band one row down; the carry of an addition runs
    along matching diagonals. The distance is followed on the lowest diagonal until that reaches the last row of
    ``a``, and along this row afterwards. ``a`` needs more than ``2 * threshold`` elements.
    """
    width = 2 * threshold + 1
    full, top = (1 << width) - 1, 1 << (width - 1)
    rows, columns = F.size(a), F.size(b)

    def flag(condition: Column) -> Column:
        return F.when(condition, 1).otherwise(0)

    def step(state: Column, i: Column) -> Column:
        vp, vn = state["vp"], state["vn"]

        def matches(word: Column) -> Column:
            found = F.lit(0)
            for k in range(width):
                found = found + F.when(F.get(a, i + threshold - k) == word, top >> k).otherwise(0)
            return found

        def diagonal(match: Column) -> Column:
            carried = (match.bitwiseAND(vp) + vp).bitwiseXOR(vp)
            return carried.bitwiseOR(match).bitwiseOR(vn).bitwiseAND(F.lit(full))

        def moved(d0: Column) -> Column:
            hp = vn.bitwiseOR(F.lit(full) - d0.bitwiseOR(vp))
            hn = d0.bitwiseAND(vp)
            down = F.shiftright(d0, 1)
            over = i + threshold + 1 - rows
            edge = F.call_function("shiftright", F.lit(top), F.greatest(over, F.lit(0)))
            along = flag(hp.bitwiseAND(edge) != 0) - flag(hn.bitwiseAND(edge) != 0)
            change = F.when(over <= 0, flag(d0.bitwiseAND(F.lit(top)) == 0)).otherwise(along)
            return F.struct(
                hn.bitwiseOR(F.lit(full) - down.bitwiseOR(hp)).alias("vp"),
                down.bitwiseAND(hp).alias("vn"),
                (state["distance"] + change).alias("distance"),
            )

        return let(let(let(F.get(b, i), matches), diagonal), moved)

    start = F.struct(
        F.lit(full - (1 << threshold) + 1).alias("vp"),
        F.lit(0).alias("vn"),
        F.lit(threshold).alias("distance"),
    )
    steps = F.sequence(F.lit(0), columns - 1)
    distance = F.aggregate(steps, start, step, lambda state: state["distance"])
    return F.when(F.abs(rows - columns) > threshold, threshold + 1).otherwise(distance)


def _stripped(pair: Column, keep: int) -> Column:
    """The arrays ``a`` and ``b`` of a pair, each backwards, without their common start, of which the last ``keep`` elements
    stay. Edit distances stay as they are."""
    same = F.zip_with(pair["a"], pair["b"], lambda x, y: x.eqNullSafe(y))
    start = F.greatest(F.array_position(same, False).cast("int") - keep, F.lit(1))

    def rest(name: str) -> Column:
        return F.reverse(F.slice(pair[name], start, F.size(pair[name]))).alias(name)

    return F.struct(rest("a"), rest("b"))


def within(a: Column, b: Column, threshold: int, most: Column | int) -> Column:
    """Whether two different lines of more than ``2 * threshold`` words are within ``most`` edits, ``threshold`` or fewer.

    The words that both begin and end with are left out first; enough of them stays for the band.
    """
    keep = 2 * threshold + 1
    words = F.struct(words_of(a).alias("a"), words_of(b).alias("b"))

    def compared(pair: Column) -> Column:
        return banded_distance(pair["a"], pair["b"], threshold) <= most

    return let(let(words, lambda p: _stripped(p, keep)), lambda p: let(_stripped(p, keep), compared))


def _pair(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("line_id"), F.greatest(a, b).alias("other")]


def candidate_pairs(
    lines: DataFrame, thresholds: Thresholds, limit: int = KEY_LIMIT
) -> tuple[DataFrame, DataFrame | None]:
    """``line_id, other`` for pairs of distinct lines (``line_id, line, size, hashes``) that may be near, and the lines of hot
    keys: those with more than ``limit`` index entries, two at most. These come out as ``key, line_id, indexed``: all of them
    probe the key, and ``indexed`` are those that the key is a segment of.
    """
    # Counted and met again from one exchange.
    rows = line_keys(lines, thresholds).repartition("key")
    indexed = F.when(F.col("own"), F.col("line_id"))
    keys = rows.groupBy("key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(indexed).alias("entries"),
        F.min(indexed).alias("first"),
        F.max(indexed).alias("last"),
    )
    keys = keys.where("rows > 1 and entries > 0").drop("rows")
    hot = F.col("entries") > min(limit, 2)
    # Few keys are met by several rows, so that these are hashed rather than all rows sorted.
    met = rows.withColumnRenamed("line_id", "other").join(keys.hint("shuffle_hash"), "key")
    met = met.where(hot | (F.col("first") != F.col("other")) | (F.col("entries") > 1))
    met = stored(met.withColumn("hot", hot), "line-met")
    both = met.where("not hot").select("other", F.explode(F.array("first", "last")).alias("line_id"))
    pairs = both.where("line_id <> other").select(*_pair(F.col("line_id"), F.col("other"))).distinct()
    if met.where("hot").isEmpty():
        return pairs, None
    # A line is indexed by the segments of its own that it probes for.
    hot = met.where("hot").groupBy("key", F.col("other").alias("line_id")).agg(F.max("own").alias("indexed"))
    return pairs, stored(hot, "line-hot")


def split_keys(lines: DataFrame, hot: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The rows of hot keys for each part of their key: ``part, line_id, indexed, sketch, size, weight``.

    Each of a line's words rarer than the first that it shares with a near one was lost by an edit. So near lines meet in the
    part of a word that is among the ``threshold + 1`` rarest of both; lines of so few words that none need be shared
    meet in a part of their own. Rarity is that among the lines of hot keys. ``weight`` is that of a line's rarest word.
    """
    most = max(_edits(thresholds))
    texts = _with_sketch(lines).join(hot.select("line_id").distinct(), "line_id", "left_semi")
    own = texts.select("line_id", F.explode(F.array_distinct("hashes")).alias("word"))
    counts = own.groupBy("word").agg(F.count(F.lit(1)).alias("lines"))
    rarest = F.array_sort(F.collect_list(F.struct("lines", "word")))
    ranked = own.join(counts, "word").groupBy("line_id").agg(rarest.alias("rarest"))
    few = F.when(F.size("rarest") <= 2 * most, F.array(F.lit(None).cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    first = F.transform(F.slice("rarest", 1, most + 1), lambda w: w["word"])
    ranked = ranked.select("line_id", F.concat(first, few).alias("parts"), F.col("rarest")[0]["lines"].alias("weight"))
    about = texts.select("line_id", "size", "sketch").join(ranked, "line_id")
    rows = hot.join(stored(about, "line-hot-words"), "line_id").withColumn("word", F.explode("parts"))
    # One value to join on; no word is another part than any word.
    part = F.xxhash64("key", F.col("word").isNull(), "word").alias("part")
    return stored(rows.select(part, "line_id", "indexed", "sketch", "size", "weight"), "line-parts")


def star_pairs(parts: DataFrame) -> DataFrame:
    """Every line that probes a part of a hot key with one line indexed there: as many rows as lines.

    That one has the most common words. Of many variants of a line it is the one that differs least from most.
    """
    order = F.struct("weight", (-F.col("line_id")).alias("earlier"))
    centres = parts.where("indexed").groupBy("part").agg((-F.max(order)["earlier"]).alias("centre"))
    rows = parts.join(centres, "part").where("line_id <> centre")
    return rows.select(*_pair(F.col("line_id"), F.col("centre"))).distinct()


def missing_pairs(parts: DataFrame, classes: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The pairs of hot keys that may be near and whose lines no chain of links connects yet.

    In a part of many lines near each other the stars have connected nearly all, so its pairs do not come up. A pair that
    shares several parts comes up in the first.
    """
    known = classes.withColumnRenamed("node", "line_id")
    # A line has no more parts than probes times words of a part, whatever the table.
    own = F.collect_set(F.when(F.col("indexed"), F.col("part"))).alias("own")
    every = parts.groupBy("line_id").agg(F.collect_set("part").alias("parts"), own)
    named = parts.join(every, "line_id").join(known, "line_id", "left")
    named = stored(named.withColumn("class", F.coalesce("component", "line_id")).drop("component"), "line-named")
    names = ["line_id", "sketch", "size", "class", "parts", "own", "indexed"]
    asking = named.select("part", *[F.col(n).alias(f"other_{n}") for n in names])
    allowed = threshold_of(F.least("size", "other_size"), thresholds)
    met = named.where("indexed").join(asking, "part")
    may_be_near = (F.col("class") != F.col("other_class")) & (flips(F.col("sketch"), F.col("other_sketch")) <= 2 * allowed)
    shared = [F.array_min(F.array_intersect(*sides)) for sides in (("own", "other_parts"), ("parts", "other_own"))]
    once = (F.least(*shared) == F.col("part")) & (~F.col("other_indexed") | (F.col("line_id") < F.col("other_line_id")))
    return met.where(may_be_near & once).select(*_pair(F.col("line_id"), F.col("other_line_id"))).distinct()


def line_classes(lines: DataFrame, thresholds: Thresholds = THRESHOLDS, limit: int = KEY_LIMIT) -> DataFrame:
    """``node, component`` for every distinct line with a link."""
    pairs, hot = candidate_pairs(lines, thresholds, limit)
    pairs = stored(pairs, "line-pairs")
    met = pairs.select("line_id").union(pairs.select("other"))
    if hot is None:
        return connected_components(verified_links(texts_of(lines, met), pairs, thresholds))
    lines = texts_of(lines, met.union(hot.select("line_id")))
    parts = split_keys(lines, hot, thresholds)
    first = pairs.unionByName(star_pairs(parts)).distinct()
    links = stored(verified_links(lines, first, thresholds), "line-links")
    more = missing_pairs(parts, connected_components(links), thresholds)
    return connected_components(links.unionByName(verified_links(lines, more, thresholds)))


def texts_of(lines: DataFrame, wanted: DataFrame) -> DataFrame:
    """The lines whose ids are wanted, by a broadcast of the ids or, beyond a size, a shuffle join. Only their words are
    hashed."""
    ids = stored(wanted.distinct(), "line-wanted")
    if ids.count() <= BROADCAST_LINES:
        ids = F.broadcast(ids)
    found = lines.select("line_id", "line", "size").join(ids, "line_id", "left_semi")
    return stored(_with_sketch(found.withColumn("hashes", hashes_of(F.col("line")))), "line-texts")


def _with_sketch(lines: DataFrame) -> DataFrame:
    return lines if "sketch" in lines.columns else lines.withColumn("sketch", sketch(F.col("hashes")))


def verified_links(lines: DataFrame, pairs: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The pairs whose lines are within their threshold."""
    texts = _with_sketch(lines).select("line_id", "line", "size", "sketch")
    others = texts.toDF("other", "line2", "size2", "sketch2")
    both = pairs.join(texts, "line_id").join(others, "other")
    both = both.withColumn("most", threshold_of(F.least("size", "size2"), thresholds))
    close = flips(F.col("sketch"), F.col("sketch2")) <= 2 * F.col("most")
    # Few bytes but much work: dealt evenly, so that adaptive execution does not put all pairs into one task.
    tasks = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = both.where(close).select("line_id", "other", "line", "line2", "most").repartition(tasks, "line_id", "other")
    both = stored(both, "line-compared")
    near = within(F.col("line"), F.col("line2"), max(_edits(thresholds)), F.col("most"))
    return both.where(near).select("line_id", "other")


def near_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", thresholds: Thresholds = THRESHOLDS
) -> DataFrame:
    """One row per line that is not blank:
    ``doc_id, text_hash, line_no, n_chars, class_doc_id, class_line_no, lines, texts, kept``.

    Lines belong to one class if a chain of links connects them. A link is between equal lines, without the white space around
    them, or between lines that at most so many words inserted, deleted or replaced part: one for lines of 5 words or more,
    two if both have 16 or more (``thresholds``). The class is named by its first line in the order of document and line
    number, which alone is kept; ``lines`` counts its lines, ``texts`` the different ones, ``n_chars`` the characters of the
    line. Line numbers start at 0. Null and empty texts have no lines. Repeated rows agree in all columns, so they keep
    the same lines; a null id comes after all others. An empty table gives an empty result; other columns are ignored.

    Equal lines are combined before they are shuffled. Only distinct lines enter the join.
    """
    if min(words for words, _ in thresholds) <= 2 * max(_edits(thresholds)):
        raise ValueError("lines need more than twice the threshold in words")
    found = line_occurrences(docs, id_column, text_column)
    distinct = found.groupBy("line").agg(F.count(F.lit(1)).alias("copies"), F.min("place").alias("first"))
    distinct = distinct.select(
        F.monotonically_increasing_id().alias("line_id"),
        "line",
        (F.octet_length("line") - F.octet_length(F.replace("line", F.lit(" "))) + 1).alias("size"),
        *_identity(F.col("line")),
        "copies",
        "first",
    )
    distinct = stored(distinct, "lines")
    shortest = min(words for words, _ in thresholds)
    lines = distinct.where(F.col("size") >= shortest)
    classes = line_classes(lines.select("line_id", "line", "size"), thresholds)
    linked = distinct.join(classes.withColumnRenamed("node", "line_id"), "line_id", "left")
    # A line that occurs once and has no link is a class of its own, which needs no lookup.
    linked = linked.where("component is not null or copies > 1").select(
        "h1", "h2", "copies", "first", F.coalesce("component", "line_id").alias("class")
    )
    known = stored(linked, "line-classes")
    totals = known.groupBy("class").agg(
        F.sum("copies").alias("lines"), F.count(F.lit(1)).alias("texts"), F.min("first").alias("class_place")
    )
    known = known.join(totals, "class").select("h1", "h2", "class_place", "lines", "texts")
    size = F.char_length("line").alias("n_chars")
    rows = found.select("doc_id", "text_hash", "line_no", "place", size, *_identity(F.col("line")))
    order = F.floor(F.col("class_place") / _LINE_NUMBERS)
    alone = F.col("class_place").isNull()
    class_doc_id = F.when(order < F.lit(_NO_ID).cast("decimal(20,0)"), order.cast("bigint"))
    class_line_no = (F.col("class_place") - order * _LINE_NUMBERS).cast("int")
    return rows.join(known.hint("shuffle_hash"), ["h1", "h2"], "left").select(
        "doc_id",
        "text_hash",
        "line_no",
        "n_chars",
        F.when(alone, F.col("doc_id").cast("bigint")).otherwise(class_doc_id).alias("class_doc_id"),
        F.when(alone, F.col("line_no")).otherwise(class_line_no).alias("class_line_no"),
        F.coalesce("lines", F.lit(1).cast("bigint")).alias("lines"),
        F.coalesce("texts", F.lit(1).cast("bigint")).alias("texts"),
        (alone | (F.col("place") == F.col("class_place"))).alias("kept"),
    )
