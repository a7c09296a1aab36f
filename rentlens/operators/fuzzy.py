"""Fuzzy name matching in built-in functions.

`best_by_edits` compares a text with a short list by Levenshtein distance. `best_matches`
finds for every text the best of any number of names by the usual weighted mix of whole,
token and partial ratios, at or above a cutoff.

The mix is never computed for all pairs. A pair at the cutoff shares a number of letter
pairs that follows from its lengths; so it suffices to look up the rarest letter pairs of
the shorter side in an index of the longer (a join), and to score pairs that share enough.
A word in common alone gives a fixed score when the lengths differ much; of the names of
one length with that word the first stands for all, so a common word adds few candidates.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rentlens.operators.spool import spool

# Fixed values of the weighted mix: lengths that differ by so much are compared in part,
# parts count less, and words count less than letters.
PARTIAL_FROM, PARTIAL_SCALE = 1.5, 0.9
FAR_FROM, FAR_SCALE = 8.0, 0.6
WORD_SCALE = 0.95
#: Letters that one 64-bit number can mark.
BITS = 62
#: Pairs of a text that are scored before the others are pruned.
SCORED_FIRST = 4
#: With no more pairs than this for each text, pruning costs more than it saves.
FEW_EACH = 16


def best_by_edits(text: Column, names: Sequence[str], cutoff: float) -> Column:
    """Struct (score, order, name) of the nearest name by Levenshtein similarity in
    percent of the longer text; the earlier name wins a tie; null below cutoff.

    The fixed name list is a literal array, so nothing is joined or shuffled.
    """
    lowered = F.lower(text)

    def candidate(entry: Column) -> Column:
        name = F.lower(entry["name"])
        longest = F.greatest(F.length(lowered), F.length(name))
        score = F.lit(100.0) * (F.lit(1.0) - F.levenshtein(lowered, name) / longest)
        return F.struct(score.alias("score"), (-entry["pos"]).alias("order"), entry["name"])

    listed = F.array(
        *[F.struct(F.lit(n).alias("name"), F.lit(i).alias("pos")) for i, n in enumerate(names)]
    )
    # Filtering the one-element array evaluates the scan over the names once.
    best = F.array(F.array_max(F.transform(listed, candidate)))
    return F.get(F.filter(best, lambda b: b["score"] >= cutoff), F.lit(0))


# --- scores ------------------------------------------------------------------------------


def once(value: Column, use) -> Column:
    """`use(value)` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\s\x1C-\x1F\x85\p{Z}]+"), lambda w: w != "")


def letters(texts: Column) -> Column:
    """For each of some texts a struct: size, chars, and for every letter the places it
    has, as bits."""

    def places(chars: Column, letter: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(0), F.least(F.size(chars), F.lit(BITS)) - 1), _long(0),
            lambda bits, i: F.when(F.get(chars, i) == letter, bits.bitwiseOR(_bit(i))).otherwise(bits),
        )

    def built(chars: Column) -> Column:
        entries = F.transform(F.array_distinct(chars), lambda c: F.struct(c, places(chars, c)))
        return F.struct(F.size(chars).alias("size"), chars.alias("chars"), F.map_from_entries(entries).alias("places"))

    return F.transform(F.transform(texts, lambda t: F.filter(F.split(t, ""), lambda c: c != "")), built)


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", _long(1), place)


def _marks(a: Column, b: Column) -> Column:
    """For every letter of b its places in a."""
    return F.transform(b["chars"], lambda c: F.coalesce(F.try_element_at(a["places"], c), _long(0)))


def _common_marked(size: Column, marks: Column) -> Column:
    """Length of the longest common subsequence of a text of at most `BITS` letters with
    letters whose places in it are given, by bit-parallel steps."""
    full = _bit(size) - 1

    def step(row: Column, mark: Column) -> Column:
        hits = row.bitwiseAND(mark)
        return (row + hits).bitwiseOR(row - hits).bitwiseAND(full)

    return size - F.bit_count(F.aggregate(marks, full, step))


def _common_rows(a: Column, b: Column) -> Column:
    """The same for long texts, row by row of the table of prefixes."""

    def step(row: Column, letter: Column) -> Column:
        def place(done: Column, i: Column) -> Column:
            here = F.get(row, i - 1) + F.when(F.get(a, i - 1) == letter, 1).otherwise(0)
            return F.concat(done, F.array(F.greatest(F.get(row, i), F.get(done, i - 1), here)))

        return F.aggregate(F.sequence(F.lit(1), F.size(a)), F.array(F.lit(0)), place)

    zero = F.transform(F.sequence(F.lit(0), F.size(a)), lambda i: F.lit(0))
    return F.element_at(F.aggregate(b, zero, step), -1)


def _by_size(a: Column, b: Column) -> Column:
    first = F.struct(a.alias("s"), b.alias("l"))
    return F.when(a["size"] <= b["size"], first).otherwise(F.struct(b.alias("s"), a.alias("l")))


def common_length(pair: Column) -> Column:
    """Length of the longest common subsequence of a shorter text s and a longer text l."""
    short, long = pair["s"], pair["l"]
    return (
        F.when(short["size"] == 0, 0)
        .when(short["size"] <= BITS, _common_marked(short["size"], _marks(short, long)))
        .otherwise(_common_rows(short["chars"], long["chars"]))
    )


def best_stretch(pair: Column) -> Column:
    """Best ratio of a text s against any stretch as long of a text l that is not shorter,
    stretches that run over either end included."""
    short, long = pair["s"], pair["l"]
    n, size = long["size"], short["size"]

    def windows(values: Column, common) -> Column:
        def one(end: Column) -> Column:
            begin = F.greatest(end - size, F.lit(0))
            taken = F.least(end, n) - begin
            return F.lit(200.0) * common(F.slice(values, begin + 1, taken)) / (size + taken)

        return F.array_max(F.transform(F.sequence(F.lit(1), n + size - 1), one))

    return (
        F.when(size == 0, F.when(n == 0, 100.0).otherwise(0.0))
        .when(size <= BITS, once(_marks(short, long), lambda m: windows(m, lambda w: _common_marked(size, w))))
        .otherwise(windows(long["chars"], lambda w: _common_rows(short["chars"], w)))
    )


def weighted_ratio(a: Column, b: Column) -> Column:
    """Best of the ratios of two sides as `side` makes them; partial ones are scaled down as
    the lengths diverge. Each kind of comparison is one expression over a list of texts:
    plans of many copies of them take longer than the pairs."""
    size_a, size_b = a["raw"]["size"], b["raw"]["size"]
    longer, shorter = F.greatest(size_a, size_b), F.least(size_a, size_b)
    near = longer / shorter < PARTIAL_FROM
    only = letters(F.array(*[F.array_join(F.array_except(x["words"], y["words"]), " ") for x, y in ((a, b), (b, a))]))
    shared = F.length(F.array_join(F.array_intersect(a["words"], b["words"]), " "))

    def compared(parts: Column) -> Column:
        only_a, only_b = F.get(parts["only"], F.lit(0)), F.get(parts["only"], F.lit(1))
        whole = [_by_size(a["raw"], b["raw"])]
        lists = F.when(near, F.array(*whole, _by_size(a["sorted"], b["sorted"]), _by_size(only_a, only_b))).otherwise(F.array(*whole))
        return once(F.transform(lists, common_length), lambda common: _mixed(a, b, parts, common, near, longer / shorter))

    parts = F.struct(F.when(near, only).alias("only"), shared.alias("shared"))
    return F.when(shorter == 0, 0.0).otherwise(once(parts, compared))


def _mixed(a: Column, b: Column, parts: Column, common: Column, near: Column, spread: Column) -> Column:
    """The score, with the common lengths of the texts as they are and, where lengths are
    near, of their sorted words and of the words that only one of them has."""

    def ratio(i: int, total: Column) -> Column:
        return F.when(total == 0, 100.0).otherwise(F.lit(200.0) * F.get(common, F.lit(i)) / total)

    whole = ratio(0, a["raw"]["size"] + b["raw"]["size"])
    in_order = ratio(1, a["sorted"]["size"] + b["sorted"]["size"])
    # Words in common against each side's.
    shared, own = parts["shared"], [F.get(parts["only"], F.lit(i))["size"] for i in (0, 1)]
    gap = F.when(shared > 0, 1).otherwise(0)
    full = [shared + gap + size for size in own]
    edits = own[0] + own[1] - 2 * F.get(common, F.lit(2))
    apart = F.lit(100.0) * (1 - edits / (full[0] + full[1]))
    against = [F.lit(100.0) * (1 - (gap + size) / (shared + f)) for size, f in zip(own, full, strict=True)]
    sets = (
        F.when((F.size(a["words"]) == 0) | (F.size(b["words"]) == 0), 0.0)
        .when((shared > 0) & ((own[0] == 0) | (own[1] == 0)), 100.0)
        .when(shared > 0, F.greatest(apart, *against)).otherwise(apart)
    )
    scale = F.when(spread <= FAR_FROM, PARTIAL_SCALE).otherwise(FAR_SCALE)
    both_ways = [
        F.struct(x[kind].alias("s"), y[kind].alias("l"), weight.alias("weight"))
        for kind, weight in (("raw", scale), ("sorted", WORD_SCALE * scale), ("unique", WORD_SCALE * scale))
        for x, y in ((a, b), (b, a))
    ]
    # A word in common settles the parts of sorted words.
    lists = F.when(shared > 0, F.array(*both_ways[:2])).otherwise(F.array(*both_ways))
    stretches = F.transform(F.filter(lists, lambda p: p["s"]["size"] <= p["l"]["size"]), lambda p: p["weight"] * best_stretch(p))
    far = F.greatest(whole, F.array_max(stretches), F.when(shared > 0, WORD_SCALE * scale * 100.0).otherwise(0.0))
    return F.when(near, F.greatest(whole, WORD_SCALE * F.greatest(in_order, sets))).otherwise(far)


def side(text: Column) -> Column:
    """What scoring needs of a text: its letters as they are, with words sorted, with
    different words sorted, and these words."""

    def built(words: Column) -> Column:
        unique = F.array_distinct(words)
        texts = F.array(text, F.array_join(words, " "), F.array_join(unique, " "))
        return once(
            letters(texts),
            lambda t: F.struct(*[F.get(t, F.lit(i)).alias(name) for i, name in enumerate(("raw", "sorted", "unique"))], unique.alias("words")),
        )

    return once(F.array_sort(words_of(text)), built)


# --- candidates ----------------------------------------------------------------------------


def pairs_of(words: Column) -> Column:
    """Neighbouring letters of each word, its ends included, each with its number among
    equal ones; and every letter by itself, for sides too short to have a pair in common."""

    def of_word(word: Column) -> Column:
        padded = F.concat(F.lit("\x02"), word, F.lit("\x03"))
        return F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substr(padded, i, F.lit(2)))

    def numbered(pairs: Column) -> Column:
        return F.transform(
            pairs, lambda p, i: F.concat(p, F.size(F.filter(F.slice(pairs, F.lit(1), i), lambda q: q == p)).cast("string"))
        )

    return once(F.flatten(F.transform(words, of_word)), numbered)


def least_common(size: Column, cutoff: float) -> Column:
    """Least pairs in common of two sides at the cutoff, of which the one with fewer letters
    in different words has `size`.

    A text of n letters has n + 1 pairs. A letter taken out costs two of them, one put in
    costs one. With L letters in common a ratio r means L >= r (n + m) / 200, so near texts
    keep 1 + n (6 r / 200 - 2) at least, for m >= n. For a part of the longer side, m is at
    least r n / (200 - r), and its ends cost two pairs.
    """
    near = cutoff / 200
    part = cutoff / PARTIAL_SCALE / 200
    by_length = 1 + size * (6 * near - 2)
    by_part = size * (1 - (2 - 3 * part) - (1 - 3 * part) * part / (1 - part)) - 1
    return F.ceil(F.least(by_length, by_part) - 1e-6).cast("int")


def _index(texts: DataFrame, cutoff: float) -> DataFrame:
    """`texts` (key and what else is to be kept): with letter pairs, and sizes."""
    words = F.array_sort(words_of(F.col("key")))
    with_words = texts.withColumn("words", words).filter(F.size("words") > 0)
    return with_words.select(
        *texts.columns, F.array_distinct("words").alias("words"), pairs_of(F.col("words")).alias("pairs"),
        F.length("key").alias("size"), F.length(F.array_join(F.array_distinct("words"), " ")).alias("least"),
    )


def _rare_first(index: DataFrame, counts: DataFrame, key: str, cutoff: float) -> DataFrame:
    """key, size, least and the pairs that cannot all be missed: the rarest of each side, as
    many as it has beyond those it must share, and one more. A side that need not share any
    has its letters instead."""
    each = index.select(key, "size", "least", F.size("pairs").alias("n"), F.explode("pairs").alias("pair"))
    ordered = each.join(counts, "pair", "left").groupBy(key, "size", "least", "n").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "pair"))).alias("found")
    )
    needed = least_common(F.col("least"), cutoff)
    first = F.transform(F.slice("found", F.lit(1), F.greatest(F.col("n") - needed + 1, F.lit(1))), lambda f: f["pair"])
    # A pair holds the letter that it ends in, but for the end of a word.
    alone = F.transform(F.col("found"), lambda f: F.substr(f["pair"], F.lit(2), F.lit(1)))
    keys = F.when(needed > 0, first).otherwise(F.array_remove(F.array_distinct(alone), "\x03"))
    return ordered.select(key, "size", "least", F.explode(keys).alias("pair"))


def _all(index: DataFrame, key: str) -> DataFrame:
    """key, size, least and every pair and letter of each side."""
    single = F.array_remove(F.array_distinct(F.transform("pairs", lambda p: F.substr(p, F.lit(2), F.lit(1)))), "\x03")
    return index.select(key, "size", "least", F.explode(F.concat("pairs", single)).alias("pair"))


def candidates(texts: DataFrame, names: DataFrame, cutoff: float) -> DataFrame:
    """key, pos and the most that its score can be, of all pairs that can reach the cutoff,
    but those of which an earlier name is as good. Both sides as `_index` makes them."""
    counts = names.select(F.explode("pairs").alias("pair")).groupBy("pair").count()
    name_all = _all(names.drop("key"), "pos").select("pos", "pair", F.col("size").alias("n_size"), F.col("least").alias("n_least"))
    name_rare = _rare_first(names.drop("key"), counts, "pos", cutoff).select(
        "pos", "pair", F.col("size").alias("n_size"), F.col("least").alias("n_least")
    )
    spread = F.greatest("size", "n_size") <= FAR_FROM * F.least("size", "n_size")
    by_text = _rare_first(texts, counts, "key", cutoff).join(name_all, "pair").filter(spread & (F.col("least") <= F.col("n_least")))
    by_name = _all(texts, "key").join(name_rare, "pair").filter(spread & (F.col("n_least") < F.col("least")))
    by_pairs = by_text.select("key", "pos").unionByName(by_name.select("key", "pos")).distinct()
    met = by_pairs.join(texts.select("key", "size", "least", "pairs"), "key").join(
        names.select("pos", F.col("size").alias("n_size"), F.col("least").alias("n_least"), F.col("pairs").alias("n_pairs")), "pos"
    )
    is_near = F.greatest("size", "n_size") < PARTIAL_FROM * F.least("size", "n_size")
    common = F.size(F.array_intersect("pairs", "n_pairs"))
    found = met.select("key", "pos", highest_possible(common, is_near).alias("most")).filter(F.col("most") >= cutoff)
    # The first name of each length stands for all that share a word with a text.
    first = names.select(F.explode("words").alias("word"), F.col("size").alias("n_size"), "pos").groupBy("word", "n_size").agg(F.min("pos").alias("pos"))
    by_word = texts.select("key", "size", F.explode("words").alias("word")).join(first, "word").filter(spread & ~is_near)
    shared = by_word.select("key", "pos", F.lit(100 * PARTIAL_SCALE * WORD_SCALE).alias("most"))
    return found.unionByName(shared).groupBy("key", "pos").agg(F.max("most").alias("most"))


def highest_possible(common: Column, is_near: Column) -> Column:
    """Bound on the weighted ratio of a pair, from the letter pairs in common: the rules of
    `least_common` solved for the letters in common. The score for a shared word when
    lengths differ is left to the first name of that word and length."""
    size, n_size = F.col("size"), F.col("n_size")
    least = F.least("least", "n_least")
    slack = F.lit(1e-6)

    def whole(total: Column, most: Column) -> Column:
        return F.lit(200.0) * F.least(most, (common - 1 + total) / 3) / total

    by_length = whole(size + n_size, F.least(size, n_size))
    by_words = F.greatest(whole(F.col("least") + F.col("n_least"), least), F.lit(200.0) * (common - 1) / (common - 1 + least))
    stretch = F.least(least, (common + 1 + least) / 2)
    by_part = F.lit(200.0) * stretch / (least + stretch)
    near = F.greatest(by_length, WORD_SCALE * F.least(by_words, F.lit(100.0)))
    far = F.greatest(by_length, PARTIAL_SCALE * by_part)
    return F.when(is_near, near).otherwise(far) + slack


# Expressions of some thousand nodes, which take longer to put together than to use.
@cache
def _score() -> Column:
    return weighted_ratio(F.col("a"), F.col("b")).alias("score")


@cache
def _side() -> Column:
    return side(F.col("key"))


def best_matches(
    texts: DataFrame, names: DataFrame, cutoff: float, match_case: bool = False
) -> DataFrame:
    """raw_string, pos and score of the best name of each text that has one at or above the
    cutoff, which must be 70 or more; the earlier name wins a tie. `texts`: raw_string;
    `names`: pos, name. White space of names counts as single spaces; a text without a word
    matches nothing."""
    if cutoff < 70:
        raise ValueError("the index is for cutoffs of 70 and more")

    def key(column: str) -> Column:
        return F.col(column) if match_case else F.lower(column)

    keyed = texts.select("raw_string", key("raw_string").alias("key"))
    tidy = F.array_join(words_of(key("name")), " ")
    # Names that are equal here score alike: the first stands for them.
    listed = spool(_index(names.select("pos", tidy.alias("key")).groupBy("key").agg(F.min("pos").alias("pos")), cutoff))
    longest = listed.agg(F.max("size")).first()[0]
    if longest is None:
        return texts.sparkSession.createDataFrame([], "raw_string string, pos long, score double")
    # Beyond eight times the longest name no score reaches the cutoff.
    asked = spool(_index(keyed.filter(F.length("key") <= int(FAR_FROM * longest)).select("key").distinct(), cutoff))
    pairs = spool(candidates(asked, listed, cutoff))
    mine, theirs = asked.select("key", _side().alias("a")), listed.select("pos", _side().alias("b"))
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    score = _score()

    def scored(some: DataFrame) -> DataFrame:
        # Pairs are small but slow to score, so they are spread over all tasks by count; left
        # alone, the planner would merge them into few tasks by their bytes.
        met = some.select("key", "pos").join(mine, "key").join(theirs, "pos").repartition(tasks, "key", "pos")
        return met.select("key", "pos", score).filter(F.col("score") >= cutoff)

    if pairs.count() <= FEW_EACH * asked.count():
        found = scored(pairs)
    else:
        # A few pairs of each text first; of the others only those that can be as good.
        turn = F.row_number().over(Window.partitionBy("key").orderBy(F.col("most").desc(), "pos"))
        first = spool(scored(pairs.withColumn("turn", turn).filter(F.col("turn") <= SCORED_FIRST)))
        floor = first.groupBy("key").agg(F.max("score").alias("floor"))
        rest = pairs.join(floor, "key", "left").filter(F.col("most") >= F.coalesce("floor", F.lit(cutoff))).join(first, ["key", "pos"], "left_anti")
        found = first.unionByName(scored(rest))
    best = found.groupBy("key").agg(F.max(F.struct("score", (-F.col("pos")).alias("order"))).alias("best"))
    return keyed.join(best, "key").select("raw_string", (-F.col("best.order")).cast("long").alias("pos"), F.col("best.score").alias("score"))
