"""Spelling variants: words one edit apart, found by a frontier of trie states that moves level by level.

The trie is a table of edges, made anew for each level from the words that still share a node: an edge
leads from a node (a prefix) over its next character, and over all that the words below have in common
after it, to a child. States without an edit (word, position, node) walk down their own path. Where it
branches they step aside, with one character replaced or inserted, and go on as states with one edit,
which only follow edges that spell the rest of the word. Those that end in a leaf are neighbours.

Of two words one edit apart, either the first or the last half of the characters agrees. So states start
side by side in the trie of the words and the trie of the reversed words, and step aside only beyond half
of their word, where few words are below a node. They step over two edges at once (one, if it leads to a
leaf) and are joined on the node and the character after the edit; other states on the node and their next
character: a word only meets the paths beside its own that go on as it does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm.tables import store, table

# Letters of a run; only A-Z are put in lower case.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words have at least so many code points and occurrences.
MIN_LENGTH, MIN_COUNT = 7, 2
# One in so many pairs of document and run loses a code point.
DAMAGE = 31
# A form is at least so many times as frequent as the word.
RATIO = 10


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, damage: int | None = DAMAGE) -> DataFrame:
    """(word, n): runs of letters in whole texts and how often they occur, if long and frequent enough.

    Where ``damage`` divides the crc32 of ``<doc_id>:<run>``, the run loses the code point at that crc32
    modulo its length; a null doc_id is written as nothing. Null texts have no runs.
    """
    # A shorter run can't give a word of min_length.
    runs = F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN[:-1] + f"{{{min_length},}}"), F.lit(0))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    word = F.col("run")
    if damage:
        h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
        at = F.pmod(h, F.length("run")).cast("int")
        shorter = F.concat(F.expr("left(run, at)"), F.expr("substr(run, at + 2)"))
        found = found.withColumns({"h": h, "at": at})
        word = F.when(F.col("h") % damage == 0, shorter).otherwise(F.col("run"))
    words = found.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


# What two words begin with: its length is halved in on, from the highest power of two below theirs.
_COMMON = """
    aggregate(
        sequence(cast(floor(log2(length(least))) as int), 0, -1), 0,
        (k, e) -> if(k + shiftleft(1, e) <= length(least) and left(least, k + shiftleft(1, e)) = left(most, k + shiftleft(1, e)), k + shiftleft(1, e), k)
    )"""


def _edges(walking: DataFrame) -> DataFrame:
    """(side, node, char, child, label, leaf, lengths): the edges below the nodes of states without an edit.

    The smallest and the largest word over an edge have in common what all words over it have in common.
    An edge over which one word goes leads to its leaf. ``label`` is what follows ``char``; ``lengths`` has
    the bits of the lengths modulo 64 of the words over the edge.
    """
    below = walking.groupBy("side", "node", F.expr("substr(word, position + 1, 1)").alias("char")).agg(
        F.count(F.lit(1)).alias("n"),
        F.min("word").alias("least"),
        F.max("word").alias("most"),
        F.expr("bit_or(shiftleft(1L, length(word) % 64))").alias("lengths"),
    )
    child = F.expr(f"if(n = 1, least, left(least, {_COMMON}))")
    edges = below.select("side", "node", "char", child.alias("child"), (F.col("n") == 1).alias("leaf"), "lengths")
    return edges.withColumn("label", F.expr("substr(child, length(node) + 2)"))


def _paths(edges: DataFrame, below: DataFrame) -> DataFrame:
    """(side, node, char, rest, child, leaf, lengths): the ways over two edges, or over one to a leaf.

    ``rest`` is what follows ``char``. Words that end at the node have no path.
    """
    first = edges.where("char <> ''").select("side", "node", "char", "label", "child", "leaf", "lengths")
    second = below.select("side", F.col("node").alias("child"), F.concat("char", "label").alias("more"), F.col("child").alias("end"), F.col("leaf").alias("ends"), F.col("lengths").alias("end_lengths"))
    one = first.where("leaf").select("side", "node", "char", F.col("label").alias("rest"), "child", "leaf", "lengths")
    two = first.where("not leaf").join(second, ["side", "child"])
    return one.unionAll(two.select("side", "node", "char", F.concat("label", "more"), "end", "ends", "end_lengths"))


def _walked(walking: DataFrame, edges: DataFrame) -> DataFrame:
    """States without an edit after the edge of their own word, where other words share it."""
    keyed = walking.select("side", "node", F.expr("substr(word, position + 1, 1)").alias("char"), "word")
    shared = edges.where("not leaf").select("side", "node", "char", "child")
    return keyed.join(shared, ["side", "node", "char"]).select("side", "word", F.length("child").alias("position"), F.col("child").alias("node"))


# From where on states step aside. The first and the last half of a word, or of a longer one with a character more,
# make up the whole: what two words have in common at both ends reaches one of both bounds.
_REPLACES, _INSERTS = "(length(word) + side) div 2", "(length(word) + 1 + side) div 2"


def _stepped(walking: DataFrame, paths: DataFrame) -> DataFrame:
    """States with an edit: those without one, beyond half of their word, over the paths beside their own.

    They are joined by the character after the edit, in the word and on the path. Pairs are found from the
    side of the smaller character, or of the shorter word.
    """
    own = F.expr("substr(word, position + 1, 1)").alias("own")
    replaced = walking.where(f"position >= {_REPLACES} and position < length(word)").select(
        "side", "node", F.expr("substr(word, position + 2, 1)").alias("next"), "word", own, F.expr("position + 1").alias("after"), F.length("word").alias("length")
    )
    inserted = walking.where(f"position >= {_INSERTS}").select(
        "side", "node", own.alias("next"), "word", own, F.col("position").alias("after"), F.expr("length(word) + 1").alias("length")
    )
    beside = F.expr("if(length = length(word), char > own, char <> own)")
    met = replaced.unionAll(inserted).join(paths.withColumn("next", F.left("rest", F.lit(1))), ["side", "node", "next"])
    return _at_end(met.where(beside))


def _went_on(aside: DataFrame, edges: DataFrame) -> DataFrame:
    """States with an edit after the next edge that spells on their word."""
    keyed = aside.select("side", "node", F.expr("substr(word, position + 1, 1)").alias("char"), "word", F.expr("position + 1").alias("after"), F.expr("length(word) + length(node) - position").alias("length"))
    return _at_end(keyed.join(edges.withColumnRenamed("label", "rest"), ["side", "node", "char"]))


def _at_end(met: DataFrame) -> DataFrame:
    """(side, word, position, node, near): states at the child, if the word goes on with ``rest`` after ``after`` characters.

    At a leaf it must end so, and the leaf's word is ``near``; elsewhere a word of the ``length`` sought may be below.
    """
    spells = "if(leaf, substr(word, after + 1) = rest, substr(word, after + 1, length(rest)) = rest)"
    found = met.where(f"(lengths & shiftleft(1L, length % 64)) <> 0 and {spells}")
    return found.select("side", "word", F.expr("after + length(rest)").alias("position"), F.col("child").alias("node"), F.when(F.col("leaf"), F.col("child")).alias("near"))


def neighbours(words: DataFrame, min_length: int = 1) -> DataFrame:
    """(a, b), a < b: all pairs of distinct words that differ by one inserted, deleted or replaced code point.

    ``words`` has distinct words in ``word``; null and empty ones are left out. No word is shorter than
    ``min_length``: the tries start at the nodes of half as many characters. Each level is stored in the
    shared folder; the driver sees whether it is empty. There are as many levels as a word has branching prefixes.
    """
    known = words.where("word is not null and word <> ''").select("word")
    sides = known.select(F.lit(0).alias("side"), "word").unionAll(known.select(F.lit(1).alias("side"), F.reverse("word").alias("word")))
    start = F.expr(f"({min_length} + side) div 2").cast("int")
    begun = sides.select("side", "word", start.alias("position"))
    walking = store(begun.withColumn("node", F.expr("left(word, position)")), "walking")
    edges = store(_edges(walking), "trie-edges")
    levels = []
    while not levels or not walking.isEmpty():
        on = store(_walked(walking, edges), "walking")
        below = store(_edges(on), "trie-edges")
        moved = _stepped(walking, _paths(edges, below))
        if levels:
            moved = moved.unionAll(_went_on(levels[-1].where("near is null"), below))
        levels.append(store(moved, "frontier"))
        walking, edges = on, below
    found = reduce(DataFrame.unionAll, levels).where("near is not null")
    turned = [F.when(F.col("side") == 1, F.reverse(c)).otherwise(F.col(c)) for c in ("word", "near")]
    return found.select(F.least(*turned).alias("a"), F.greatest(*turned).alias("b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): forms followed to the last, by doubling. Forms must not run in circles."""
    reached = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = reached.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        moved = store(moved, "roots")
        reached = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return reached


def variants(counts: DataFrame, ratio: int = RATIO, min_length: int = MIN_LENGTH) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words with their counts (word, n).

    The form is the most frequent neighbour, the smallest in code-point order of several, if it is at least
    ``ratio`` (2 or more) times as frequent; the root is where forms lead to in the end, the word itself
    without one. ``n_near`` is 0 without a neighbour. An empty table gives no row.
    """
    counts = store(counts.select("word", "n"), "word-counts")
    pairs = store(neighbours(counts, min_length), "neighbours")
    both = pairs.unionAll(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = (
        both.join(counts.select(F.col("word").alias("b"), F.col("n").alias("near_n")), "b")
        .groupBy(F.col("a").alias("word"))
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "b")).alias("best"))
    )
    joined = counts.join(best, "word", "left").withColumn("near_n", -F.col("best.less"))
    is_form = F.col("near_n") >= ratio * F.col("n")
    found = store(
        joined.select(
            "word",
            F.when(is_form, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, F.col("near_n")).alias("form_n"),
        ),
        "forms",
    )
    roots = _roots(found.where("form is not null"))
    rooted = found.join(roots, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variants among the words of all documents. Null texts and empty tables have no words; copies count again."""
    return variants(word_counts(table(spark, sf_dir, "documents")))


ORACLE = {
    "op11_spelling_variants": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list(c ORDER BY i) AS t FROM (
                SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: xor(c >> 1, (c & 1) * 3988292384)) AS c
                FROM range(256) AS r(i))
        ), runs AS (
            SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
            FROM documents
        ), coded AS (
            SELECT run, list_transform(string_split(id || ':' || run, ''), lambda x: unicode(x)) AS points FROM runs WHERE length(run) >= 7
        ), bytes AS (
            SELECT run, flatten(list_transform(points, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + (p >> 6), 128 + (p & 63)] END)) AS b FROM coded
        ), hashed AS (
            SELECT run, xor(4294967295, list_reduce(
                list_prepend(4294967295::BIGINT, list_transform(b, lambda x: x::BIGINT)),
                lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h
            FROM bytes, crc_table
        ), words AS (
            SELECT word, count(*) AS n FROM (
                SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word FROM hashed)
            WHERE length(word) >= 7 GROUP BY 1 HAVING count(*) >= 2
        ), cut AS (
            SELECT word, i, word[:i - 1] || word[i + 1:] AS rest
            FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), pairs AS (
            SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
            UNION SELECT cut.word, w.word FROM cut JOIN words w ON cut.rest = w.word
            UNION SELECT w.word, cut.word FROM cut JOIN words w ON cut.rest = w.word
        ), near AS (
            SELECT a AS word, count(*) AS n_near, max(n) AS near_n, first(b ORDER BY n DESC, b) AS form
            FROM pairs JOIN words ON word = b GROUP BY a
        ), forms AS (
            SELECT w.word, CASE WHEN near_n >= 10 * n THEN form END AS form, n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
            FROM words w LEFT JOIN near ON near.word = w.word
        ), steps(word, root) AS (
            SELECT word, word FROM forms
            UNION ALL SELECT steps.word, forms.form FROM steps JOIN forms ON forms.word = steps.root WHERE forms.form IS NOT NULL
        ), roots AS (
            SELECT steps.word, steps.root FROM steps JOIN forms ON forms.word = steps.root WHERE forms.form IS NULL
        )
        SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
    """
}
